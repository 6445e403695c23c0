"""Near-duplicate vectors and nearest neighbours against brute force."""

import numpy as np
import pytest

from tidelog.llm import onebit_ann, pq_dedup
from tidelog.llm.components import connected_components

SCHEMA = "vec_id long, embedding array<float>, label int"


def cosine(a, b):
    a, b = (np.asarray(x, float) / np.abs(np.asarray(x, float)).max() for x in (a, b))
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def sample(n=300, width=12, seed=3):
    """Random vectors, copies, near copies and scaled copies, in three labels."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0 or not rows:
            v = rng.standard_normal(width)
        else:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.choice([0, 0.03, 0.08]) * rng.standard_normal(width)
            v = v * rng.choice([1, 2.5])
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3))))
    return rows


def odd_rows(width=12):
    one = [1.0] * width
    return [
        (1000, None, 0), (1001, [], 0), (1002, [0.0] * width, 0), (1003, [float("nan"), *one[1:]], 0),
        (1004, [float("inf"), *one[1:]], 0), (1005, [None, *one[1:]], 0), (1006, one, None),
        (1007, one, None), (1008, one[:5], 1), (1009, one[:5], 1),
    ]


def links_by_hand(rows, threshold):
    out = {r[0]: set() for r in rows}
    for i, (a, v, x) in enumerate(rows):
        for b, w, y in rows[i + 1 :]:
            if x is None or x != y or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            if cosine(v, w) >= threshold:
                out[a].add(b)
                out[b].add(a)
    return out


def components_by_hand(links):
    found = {}
    for start in sorted(links):
        if start in found:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in found:
                found[x] = start
                todo += links[x]
    return found


@pytest.mark.parametrize("options", [{}, {"block_rows": 16, "list_rows": 8}])
def test_near_duplicates_by_hand(spark, options):
    rows = sample() + odd_rows()
    links = links_by_hand(rows, 0.98)
    parts = components_by_hand(links)
    got = pq_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.98, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == (len(links[r.vec_id]), parts[r.vec_id]), r
        assert r.kept == (r.vec_id == r.component_id)


def test_near_duplicates_without_rows_ids_or_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pq_dedup.near_duplicates(empty).collect() == []
    rows = [(None, [1.0, 0.0], 1), (4, None, 1), (5, [0.0, 0.0], None)]
    got = {r.vec_id: tuple(r)[1:] for r in pq_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {None: (0, None, True), 4: (0, 4, True), 5: (0, 5, True)}


def test_near_duplicates_with_repeated_ids_and_clashing_columns(spark):
    rows = [(7, [1.0, 0.0], 1, 1), (7, [1.0, 0.0], 1, 2), (9, [1.0, 0.01], 1, 3)]
    df = spark.createDataFrame(rows, SCHEMA + ", id long").withColumnRenamed("id", "cell")
    got = sorted(tuple(r) for r in pq_dedup.near_duplicates(df).collect())
    assert got == [(7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False)]


def test_table_distances_are_distances_to_the_reconstruction():
    rng = np.random.default_rng(1)
    units = pq_dedup.unit_rows(rng.standard_normal((400, 10)))
    model = pq_dedup.train(units, lists=4, subspaces=4, codes=16)
    cell, codes, left = pq_dedup.quantise(units, model)
    members = np.flatnonzero(cell == 2)
    centre = model["centres"][2]
    rebuilt = np.tile(centre, (len(members), 1))
    for i, (p, b) in enumerate(zip(model["parts"], model["books"], strict=True)):
        rebuilt[:, p] += b[codes[members, i]]
    want = np.linalg.norm(units[:7, None] - rebuilt[None], axis=2)
    assert np.allclose(pq_dedup.table_distances(units[:7], codes[members], centre, model), want)
    assert np.allclose(np.linalg.norm(units[members] - rebuilt, axis=1), left[members])


def test_probes_reach_every_list_within_the_radius():
    rng = np.random.default_rng(2)
    units = pq_dedup.unit_rows(rng.standard_normal((500, 6)))
    model = pq_dedup.train(units, lists=12, subspaces=2, codes=8)
    cell, _, _ = pq_dedup.quantise(units, model)
    row, probed = pq_dedup.probes(units, cell, model, 0.3)
    probing = set(zip(row.tolist(), probed.tolist(), strict=True))
    gap = np.linalg.norm(units[:, None] - units[None], axis=2)
    for a, b in zip(*np.nonzero(gap <= 0.3), strict=True):
        assert (int(a), int(cell[b])) in probing


def neighbours_by_hand(rows, queries, k):
    out = set()
    for q, v, _ in queries:
        if not usable(v):
            continue
        found = [(-cosine(v, w), i) for i, w, _ in rows if i != q and usable(w) and len(w) == len(v)]
        out |= {(q, rank, i) for rank, (_, i) in enumerate(sorted(found)[:k], 1)}
    return out


def test_search_by_hand(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(16))], 0) for i in range(600)]
    rows += odd_rows(16)
    df = spark.createDataFrame(rows, SCHEMA)
    got = onebit_ann.top_k(df, df.where("vec_id % 50 = 0"), 5, block_rows=64, query_rows=4).collect()
    want = neighbours_by_hand(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert len({tuple(r)[:3] for r in got} & want) >= 0.99 * len(want)
    assert len(got) == len(want)
    vectors = {i: v for i, v, _ in rows}
    for r in got:
        assert r.score == pytest.approx(cosine(vectors[r.query_id], vectors[r.vec_id]), abs=1e-12)


def test_search_in_rows_and_lanes(spark, monkeypatch):
    """Several rows and lanes of tasks: vectors meet each query once and never travel in pairs with them."""
    monkeypatch.setattr(onebit_ann, "_HELD", 64)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(16))], 0) for i in range(400)] + odd_rows(16)
    df = spark.createDataFrame(rows, SCHEMA)
    found = onebit_ann.top_k(df, df.where("vec_id % 20 = 0"), 5, block_rows=16, query_rows=4)
    assert "Join" not in found._jdf.queryExecution().toString()
    want = neighbours_by_hand(rows, [r for r in rows if r[0] % 20 == 0], 5)
    assert {tuple(r)[:3] for r in found.collect()} == want


def test_search_of_copies_takes_the_smallest_ids(spark):
    rng = np.random.default_rng(8)
    one, other = ([float(x) for x in np.float32(rng.standard_normal(300))] for _ in range(2))
    rows = [(int(i), one if i % 3 else other, 0) for i in rng.permutation(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = onebit_ann.top_k(df, df.where("vec_id % 10 = 0"), 4, block_rows=16).collect()
    for q in range(0, 500, 10):
        alike = [i for i in range(500) if i != q and (i % 3 == 0) == (q % 3 == 0)][:4]
        assert sorted((r.rank, r.vec_id) for r in got if r.query_id == q) == list(enumerate(alike, 1))


def blocks(vectors, turn, epsilon):
    """Blocks of 128 vectors, as a task gets them ready."""
    norms = np.linalg.norm(vectors, axis=1)
    for lo in range(0, len(vectors), 128):
        part = slice(lo, lo + 128)
        units = onebit_ann.unit_rows(vectors[part])
        ids = np.arange(lo, lo + len(units))
        coded = onebit_ann.prepare(onebit_ann.encode(units, turn), units.shape[1], epsilon)
        single = units.astype(np.float32)
        yield {"ids": ids, "once": ids - lo, "data": vectors[part], "norm": norms[part], "single": single} | coded


@pytest.mark.parametrize("spread, most", [(1.0, 0.02), (0.02, 0.05)])
def test_search_reranks_what_the_best_of_all_blocks_leaves(spread, most):
    """Of random vectors, and of families of 20, few are compared exactly once some blocks are met."""
    rng = np.random.default_rng(9)
    families = np.repeat(rng.standard_normal((200, 96)), 20, axis=0)
    vectors = rng.permutation((families if spread < 1 else 0) + spread * rng.standard_normal((4000, 96)))
    turn, k = onebit_ann.rotation(96, 7), 5
    mine = vectors[:100]
    asked = {"ids": np.arange(100), "data": mine, "norm": np.linalg.norm(mine, axis=1)}
    asked |= {"found": np.zeros((100, k), np.int64), "score": np.full((100, k), -np.inf)}
    asked |= onebit_ann.ask(onebit_ann.unit_rows(mine), turn)
    adds = onebit_ann.tables(asked)
    exact = sum(onebit_ann.search_block(b, asked, adds, k) for b in blocks(vectors, turn, 5.0))
    units = onebit_ann.unit_rows(vectors)
    near = units[:100] @ units.T
    near[np.arange(100), np.arange(100)] = -1
    assert (asked["found"] == np.argsort(-near, axis=1)[:, :k]).all()
    assert exact <= most * near.size


def test_search_ties_repeats_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0], 0), (3, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (0, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r)[:3] for r in onebit_ann.top_k(df, df.where("vec_id = 0"), 5).collect())
    assert got == [(0, 1, 2), (0, 2, 3)]
    empty = spark.createDataFrame([], SCHEMA)
    assert onebit_ann.top_k(empty, empty, 5).collect() == []
    assert onebit_ann.top_k(df, empty, 5).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_vectors_of_any_finite_size(spark):
    """Components of 1e-200 and 1e200: squares of neither can be worked out as they are."""
    wide = "vec_id long, embedding array<double>, label int"
    rows = [(0, [1.0, 0.0], 0), (1, [1e-200, 0.0], 0), (2, [0.9, 0.1], 0), (3, [0.0, 1.0], 0), (4, [1e200, 0.0], 0)]
    rows += [(5, [5e-324, 0.0], 0), (6, [1.7e308, 1.7e308], 0), (7, [1e-310, 1e-310], 0)]
    df = spark.createDataFrame(rows, wide)
    got = {(r.query_id, r.rank): r for r in onebit_ann.top_k(df, df, 5).collect()}
    vectors = {i: v for i, v, _ in rows}
    for q, rank, near in neighbours_by_hand(rows, rows, 5):
        # Vectors of one direction tie but for the last bit.
        assert got[q, rank].score == pytest.approx(cosine(vectors[q], vectors[near]), abs=1e-12)
        assert got[q, rank].score == pytest.approx(cosine(vectors[q], vectors[got[q, rank].vec_id]), abs=1e-12)
    assert [got[0, rank].vec_id for rank in (1, 2, 3)] == [1, 4, 5] and len(got) == 40
    links = links_by_hand(rows, 0.98)
    parts = components_by_hand(links)
    found = {tuple(r)[:3] for r in pq_dedup.near_duplicates(df).collect()}
    assert found == {(i, len(links[i]), parts[i]) for i in links} and len(links[4]) == 4


@pytest.mark.parametrize("width", [3, 64, 100])
def test_code_bounds_hold_and_tell(width):
    rng = np.random.default_rng(width)
    units = onebit_ann.unit_rows(rng.standard_normal((300, width)))
    turn = onebit_ann.rotation(width, 7)
    codes = onebit_ann.encode(units, turn)
    estimate, half = onebit_ann.bounds(codes, units[:40], turn, 3.0)
    off = np.abs(estimate - units[:40] @ units.T)
    assert (off <= half).mean() > 0.99 and np.abs((estimate - units[:40] @ units.T).mean()) < 0.02
    if width > 3:
        assert half.mean() < 0.5


@pytest.mark.parametrize("width", [1, 12, 64, 300])
def test_fewest_counts_are_the_bounds_solved(width):
    rng = np.random.default_rng(width)
    units = onebit_ann.unit_rows(rng.standard_normal((200, width)))
    turn = onebit_ann.rotation(width, 7)
    codes = onebit_ann.encode(units, turn)
    asked, coded = onebit_ann.ask(units[:50], turn), onebit_ann.prepare(codes, width, 3.0)
    estimate, half = onebit_ann.bounds(codes, units[:50], turn, 3.0)
    counts = onebit_ann._count(onebit_ann.tables(asked), coded["columns"])
    signs = np.unpackbits(codes["bits"].view(np.uint8), axis=1)[:, :width].astype(np.int64)
    assert (counts == signs @ asked["rounded"].T.astype(np.int64)).all()
    for bar in (-0.5, 0.0, 0.3, 0.9):
        got = (counts >= onebit_ann.fewest(coded, asked, np.full(50, bar))).T
        # None is left out that reaches the bar, and few more are let in than that.
        assert got[estimate + half >= bar].all()
        assert not got[estimate + half < bar - 3 * onebit_ann._slack(width)].any()
