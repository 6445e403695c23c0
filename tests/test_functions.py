from pyspark.sql import functions as F

from tests.conftest import day
from tidelog.functions import bands, geo, identity, instants, text


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


PLACES = [
    ("Mill Bakery", 48.2081, 16.3713),
    ("Dock Diner", 48.2081, 16.3713),
    ("Mill Bakery", 48.2082, 16.3714),
    ("  mill BAKERY ", 48.20811, 16.37129),
    (None, 25.0, 121.0),
    ("x", None, 121.0),
    ("x", 25.0, None),
]


def test_stable_id(spark):
    df = spark.createDataFrame(PLACES, "name string, lat double, lng double")
    parts = F.col("name"), F.col("lat"), F.col("lng")
    got = df.select(identity.stable_id(*parts), identity.reject_reason(*parts)).collect()
    ids = [r[0] for r in got]
    assert ids[0] == "a0b48e98a824" and ids[3] == ids[0]
    assert len(set(ids[:3])) == 3 and all(len(i) == 12 for i in ids[:3])
    assert ids[4:] == [None] * 3
    assert [r[1] for r in got[3:]] == [None, "missing name", "missing latitude", "missing longitude"]


def test_coordinates_round_half_up(spark):
    df = spark.createDataFrame([("a", 25.04115, 2.00005), ("a", 25.0412, 2.0001)], "n string, a double, b double")
    ids = df.select(identity.stable_id(F.col("n"), F.col("a"), F.col("b"))).distinct()
    assert ids.count() == 1


INSTANTS = ["20250525133550354", "20250525133550", "20250525", "abc", None, "", "20251325133550354"]


def test_only_seventeen_digits_are_an_instant(spark):
    parsed = column(spark, INSTANTS, "string", instants.parse_instant)
    assert str(parsed[0]) == "2025-05-25 13:35:00" and parsed[1:] == [None] * 6
    assert column(spark, INSTANTS, "string", instants.is_instant) == [True] + [False] * 6


def test_date_text(spark):
    assert column(spark, INSTANTS, "string", instants.format_date) == [
        "May 25, 2025",
        "2025052513",
        "20250525",
        "abc",
        "Invalid date",
        "Invalid date",
        "2025132513",
    ]
    assert column(spark, INSTANTS[:4], "string", instants.format_date_time) == [
        "May 25, 2025 • 1:35 PM",
        "20250525133550",
        "20250525",
        "abc",
    ]
    assert column(spark, INSTANTS, "string", instants.date_label) == (
        ["May 25, 2025"] + ["Invalid date"] * 3 + ["N/A"] * 2 + ["Invalid date"]
    )
    assert column(spark, INSTANTS, "string", instants.tooltip_date) == [
        "May 25, 2025 • 1:35 PM",
        "2025-05-25 • 13:35",
        "2025-05-25",
        "abc",
        "Invalid date",
        "Invalid date",
        "20251325133550354",
    ]


def test_instants_sort_as_text():
    assert day(9) < day(10) < day(1, month=2)


def test_number_text(spark):
    values = [0.3, -0.2, 0.0, None, 4.5 - 4.2, 12.25]
    signed = column(spark, values, "double", text.signed_text)
    assert signed == ["+0.3", "-0.2", "0.0", "-", "+0.3", "+12.3"]
    assert column(spark, [25.1, None], "double", lambda c: text.fixed_text(c, 4)) == ["25.1000", None]


def test_labels(spark):
    labels = [["cafe", "meal_take_away"], [], None, ["x"]]
    got = column(spark, labels, "array<string>", text.label_text)
    assert got == ["Cafe, Meal take_away", "", "N/A", "X"]
    stored = ['["cafe","tea_house"]', "plain_text", "", None, "[broken", '{"a":1}']
    got = column(spark, stored, "string", text.label_text_from_json)
    assert got == ["Cafe, Tea house", "plain_text", "N/A", "N/A", "[broken", '{"a":1}']


def test_bands(spark):
    values = [5.0, 4.5, 4.4, 4.0, 3.0, 2.9, 0.0, -1.0, 6.0, None]
    assert column(spark, values, "double", bands.band) == [
        "excellent",
        "excellent",
        "good",
        "good",
        "average",
        "poor",
        "poor",
        "poor",
        "excellent",
        "",
    ]
    percent = column(spark, values, "double", bands.percent_of_scale)
    assert percent == [100.0, 90.0, 88.0, 80.0, 60.0, 58.0, 0.0, 0.0, 100.0, 0.0]
    directions = column(spark, [0.1, 0.0, -0.1, None], "double", bands.direction)
    assert directions == ["positive", "negative", "negative", ""]


def test_the_box_contains_the_circle(spark):
    centres = [(25.0, 121.5), (0.0, 179.99), (10.0, -179.99), (89.99, 10.0), (-60.0, 0.0)]
    for lat, lng in centres:
        around = spark.range(20000).select(
            F.greatest(F.least(lat + (F.rand(1) - 0.5) * 0.4, F.lit(90.0)), F.lit(-90.0)).alias("lat"),
            (F.pmod(F.lit(lng) + (F.rand(2) - 0.5) * 0.8 + 180.0, F.lit(360.0)) - 180.0).alias("lng"),
        )
        inside = geo.haversine(F.col("lat"), F.col("lng"), lat, lng) <= 5000
        boxed = geo.bounding_box(F.col("lat"), F.col("lng"), lat, lng, 5000)
        got = around.agg(F.count_if(inside), F.count_if(inside & boxed)).first()
        assert got[0] == got[1] > 0


def test_distance(spark):
    one_degree = spark.range(1).select(geo.haversine(F.lit(1.0), F.lit(0.0), 0.0, 0.0)).first()[0]
    assert abs(one_degree - 111194.93) < 0.01
