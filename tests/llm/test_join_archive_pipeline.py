"""The n-gram join, the archive and the pipeline against brute force."""

import base64
import collections
import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import check_oracle
import corpus_pipeline
from tests.llm.test_text_operators import lines_by_hand
from tidelog.llm import line_dedup, mil_quality, ngram_join, packing, secret_scan, warc
from tidelog.llm import queries as llm
from tidelog.llm import textscan as ts

SF_DIR = "/root/testdata/sf0.001"


def gram_sets(rows, n):
    """id -> set of n-grams, by the definition."""
    out = {}
    for i, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        whole = {tuple(words)} if words else set()
        out[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or whole
    return out


def groups_by_hand(rows, n, threshold):
    """id -> (size of its set, smallest id reachable by links)."""
    sets, t = gram_sets(rows, n), Fraction(threshold)
    holders = collections.defaultdict(list)
    for i in sorted(sets):
        for gram in sets[i]:
            holders[gram].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sorted(sets):
        for b, common in collections.Counter(b for g in sets[a] for b in holders[g] if b > a).items():
            if common >= t * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, n=220):
    """Texts of a few words to a few hundred, many of them one or two words apart."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(50)] + ["É", "ß", "Word", "word"]
    bases = [[rng.choice(words) for _ in range(rng.choice([1, 2, 4, 12, 30, 90]))] for _ in range(20)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(text)))
    return [*rows, (900, None), (901, ""), (902, " \t\n"), (903, "x " * 30_000), (904, "x " * 30_001)]


def found_groups(df, n, threshold):
    got = ngram_join.similar_classes(df, n, threshold).collect()
    assert len({r.doc_id for r in got}) == len(got)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


@pytest.mark.parametrize("n, threshold", [(3, "0.9"), (5, "0.8"), (2, "0.5")])
def test_similar_texts_by_hand(make_docs, n, threshold):
    rows = near_copies(n)
    assert found_groups(make_docs(*rows), n, threshold) == groups_by_hand(rows, n, threshold)


def test_a_family_that_is_near_but_not_linked(make_docs):
    """Members share most of a text in pairs; only a few of them are near enough."""
    rng = random.Random(4)
    base = [f"v{i}" for i in range(80)]
    rows = []
    for i in range(120):
        text = list(base)
        for k in rng.sample(range(80), rng.choice([1, 3, 4])):
            text[k] = f"x{rng.randrange(6)}"
        rows.append((i, " ".join(text)))
    assert found_groups(make_docs(*rows), 3, "0.8") == groups_by_hand(rows, 3, "0.8")


def test_hot_marks_are_split_and_lose_no_link(make_docs, monkeypatch):
    """Every mark on more than two rows is hot: copies, near copies and a family that is not linked."""
    monkeypatch.setattr(ngram_join, "_HOT", 2)
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 60)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(60, i % 7, replace=False):
            words[at] = f"x{i % 9}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"v{i % 3}_{j}" for j in range(30))) for i in range(12)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_classes(make_docs(*rows), 3, "0.8").collect()}
    assert got == groups_by_hand(rows, 3, "0.8") and len({c for _, c in got.values()}) > 3


@pytest.mark.parametrize("threshold", ["0.9", "0.8", "0.5"])
def test_linked_sets_always_show_a_common_mark(threshold):
    shape, rng = ngram_join.Shape(Fraction(threshold)), np.random.default_rng(5)
    t = Fraction(threshold)
    tried = 0
    while tried < 1500:
        size = int(rng.choice([1, 2, 3, 5, 9, 10, 15, 16, 17, 31, 33, 64, 200]))
        a = rng.integers(0, 2**64, size, dtype=np.uint64)
        drop, add = rng.integers(0, size // 3 + 1, 2)
        b = np.concatenate([a[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)])
        common, union = size - drop, size + add
        if not len(b) or common < t * union:
            continue
        tried += 1
        shown = [set(ngram_join.signatures(np.sort(x), shape).tolist()) for x in (a, b)]
        assert shown[0] & shown[1], (size, drop, add)


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**64, 60, dtype=np.uint64))
        b = np.unique(np.concatenate([a[5:], rng.integers(0, 2**64, 9, dtype=np.uint64)]))
        both = ngram_join.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        bits = np.bitwise_count((both[0] ^ both[1]).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_groups_with_nulls_repeats_clashes_and_nothing(spark, make_docs, no_docs):
    assert ngram_join.similar_classes(no_docs).collect() == []
    text = "one two three four five six seven"
    docs = make_docs((5, text), (5, text), (7, text), (None, text), (9, None), (5, "other")).withColumnRenamed("lang", "n")
    got = sorted((tuple(r) for r in ngram_join.similar_classes(docs).collect()), key=repr)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (5, 1, 5), (7, 3, 5), (None, 3, None), (9, 0, 9)], key=repr)


def test_ngrams_are_those_of_the_definition():
    rows = near_copies(8, 60)
    sets = gram_sets(rows, 3)
    block = next(ts.blocks(pa.array([t for _, t in rows]), most_bytes=10**8))
    grams, bounds = ngram_join.ngram_sets(block, 3)
    own = {i: set(grams[a:b].tolist()) for (i, _), a, b in zip(rows, bounds, bounds[1:])}
    for i in own:
        assert len(own[i]) == len(sets[i])
        for j in own:
            assert len(own[i] & own[j]) == len(sets[i] & sets[j])


# --- archive ------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_archive_round_trip(spark, tmp_path):
    rows = [
        (1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, "u\r\nX: y", "other\r\n\r\nline"), (4, None, None),
        (5, "http://a/5", ""), (2, "http://a/2", "<p>é</p>"), (None, "http://n", "<p>é</p>"), (6, "u", "x" * 100_000),
    ]
    df = spark.createDataFrame(rows, PAGES).withColumn("sha256", F.lit("clash"))
    path = str(tmp_path / "archive")
    warc.write_archive(df, path)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows)
    body = {i: (html or "").encode() for i, _, html in rows}
    for r in got:
        assert r.payload_bytes == len(body[r.page_id])
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body[r.page_id]).digest()).decode()
    kinds = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in got), key=repr)
    assert kinds == sorted(
        [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None), (3, "response", None),
         (4, "revisit", 5), (5, "response", None), (6, "response", None)], key=repr)
    for r in warc.reconstruct(spark, path).collect():
        header, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in header.decode().split("\r\n")[1:])
        page = re.search(r"urn:page:(\w+)", r.record_id)[1]
        payload = body[None if page == "none" else int(page)]
        assert rest == payload + b"\r\n\r\n" and int(fields["Content-Length"]) == len(payload)
        assert header.startswith(b"WARC/1.1") and fields["WARC-Record-ID"] == r.record_id


def test_small_payloads_and_damage(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], PAGES)
    path = str(tmp_path / "archive")
    warc.write_archive(df, path, min_bytes=3)
    got = {r.page_id: r.record_type for r in warc.read_archive(spark, path).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    stored = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"changed"))
    damaged = str(tmp_path / "damaged")
    stored.write.parquet(f"{damaged}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{damaged}/records")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(spark, damaged).collect()
    empty = str(tmp_path / "empty")
    warc.write_archive(df.limit(0), empty)
    assert warc.read_archive(spark, empty).collect() == []


# --- queries and pipeline --------------------------------------------------------


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_agrees_with_its_sql(spark, name):
    import duckdb

    sql = duckdb.connect()
    for table in check_oracle.TABLES:
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    assert check_oracle.compare(spark, sql, SF_DIR, name).startswith("equal")


def test_pipeline_stage_by_stage_by_hand(spark, tmp_path, make_docs):
    rng = random.Random(12)
    words = "a quiet morning by the old river where boats pass slowly under grey bridges".split()
    rows = []
    for i in range(150):
        lines = [" ".join(rng.choices(words, k=40)) for _ in range(4)]
        if i % 2:
            lines.insert(rng.randint(0, 4), "Share this page with your friends")
        if i % 9 == 0:
            lines.append("password=hunter2hunter2x" + str(i % 7))
        text = "\n".join(lines) if i % 5 else " ".join(w.upper() + "!!" for w in rng.choices(words, k=160))
        rows.append((i, text, "en", rng.choice(["s1", "s1", "s2"])))
    rows += [(150 + k, rows[7][1], "en", "s1") for k in range(5)]
    rows += [(160, rows[8][1].replace("river", "lake", 1), "fr", "s2"), (None, rows[11][1], "en", "s1"), (170, "", "en", None)]
    docs = make_docs(*rows)
    labels = [(i, int(i % 5 > 0), 0) for i in range(100)]
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "lines", "near_duplicates", "secrets", "packed"]

    kept = stages["quality"](spark, docs, folder)
    assert kept.columns == docs.columns
    model = mil_quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r.doc_id: r.score for r in mil_quality.score(docs, model).collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {i for i, s in scores.items() if s >= 0.3}
    assert {i for i in range(150) if i % 5} <= ids and not {i for i in range(150) if i % 5 == 0} & ids

    now = [tuple(r)[:4] for r in kept.collect()]
    cleaned = stages["lines"](spark, kept, folder)
    want = lines_by_hand(now, 0.1, 5)
    assert sorted(((r.doc_id, r.text) for r in cleaned.collect()), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in cleaned.collect()) and cleaned.columns == docs.columns
    assert not cleaned.where("text LIKE '%Share this%'").count()

    single = stages["near_duplicates"](spark, cleaned, folder)
    groups = groups_by_hand([(i, t) for i, t in want if i is not None], 5, "0.8")
    first = sorted({c for _, c in groups.values()})
    assert sorted((r.doc_id for r in single.collect()), key=repr) == sorted([*first, None], key=repr)
    assert len(first) < len(groups) and single.columns == docs.columns

    masked = stages["secrets"](spark, single, folder)
    assert masked.columns == docs.columns and masked.count() == single.count()
    assert not masked.where("text LIKE '%hunter2%'").count()
    assert masked.where("text LIKE '%[SECRET]%'").count() == single.where("text LIKE '%hunter2%'").count() > 0

    last = stages["packed"](spark, masked, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = [len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in masked.collect()]
    assert sum(r.length for r in last) == sum(lengths)
    bound = packing.lower_bound(np.bincount([r.length for r in last], minlength=2049), 2048)
    assert len({r.sequence_id for r in last}) == bound

    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id or -1, r.piece, r.length, r.ids_crc32) for r in whole) == sorted(
        (r.doc_id or -1, r.piece, r.length, r.ids_crc32) for r in last
    )


def test_repeated_rows_leave_one_and_rows_without_id_stay(spark, make_docs):
    text = "one two three four five six"
    docs = make_docs((3, text), (3, text), (4, text), (None, text), (None, text), (8, None))
    got = sorted((r.doc_id or 0) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == [0, 0, 3, 8]


def test_stages_of_an_empty_table(spark, tmp_path, no_docs):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.collect() == []
