"""Nearest neighbours by randomly rotated one-bit codes, reranked exactly.

Rows are packed into blocks and encoded there, once.  Within a block each unit vector is taken
relative to the block's mean, rotated at random and kept as one sign bit per dimension with two
scalars: the length of the residual, and the inner product of the rotated direction with its own
code.  A query is rotated and rounded to eight bits a dimension; its inner product with a code is
counted on packed bits, a byte of the code at a time, by tables of what each byte adds for a set of
queries.  That gives an unbiased estimate of the cosine and an error bound; vectors whose upper
bound reaches the k-th best exact score are reranked in double precision.  Where the bounds leave
many, products in single precision and the bound of their rounding choose among all of the block
first.  A task holds its queries with the best k of each, its bar, over all blocks that pass by.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.vectors import as_matrix, balanced, unit_rows, usable

_BLOCK = "dim int, ids binary, data binary"
_CODED = _BLOCK + ", bits binary, length binary, own binary, centre binary"
_PLANES = 8
_BYTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)
_COUNTED = 512  # queries that share tables
_WAITING = 8192  # vectors that meet the same tables
_HELD = 2**22  # components of the queries in a task
_FEW = 1 / 256  # of the pairs of a block: so many are cheaper one by one than as a product
# The bar is the best of all blocks met so far and sharper than a block's own, so the bound is
# taken wider against it: what one block's bar would not have lost is not lost either.
_SHARPER = 5 / 3


def rotation(width: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def encode(units: np.ndarray, turn: np.ndarray) -> dict:
    """One-bit codes of unit rows and their correction scalars."""
    centre = units.mean(axis=0)
    residual = (units - centre) @ turn.T
    length = np.linalg.norm(residual, axis=1)
    direction = residual / np.maximum(length, 1e-300)[:, None]
    signs = direction > 0
    own = np.abs(direction).sum(axis=1) / np.sqrt(units.shape[1])
    return {
        "bits": _words(signs),
        "length": length,
        "own": np.maximum(own, 1e-12),
        "centre": centre,
    }


def _words(signs: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, filled with zeros."""
    packed = np.packbits(signs, axis=1)
    whole = np.zeros((len(packed), -(-signs.shape[1] // 64) * 8), np.uint8)
    whole[:, : packed.shape[1]] = packed
    return whole.view(np.uint64)


def ask(units: np.ndarray, turn: np.ndarray) -> dict:
    """Unit queries, rotated and rounded to whole steps from the least component on."""
    turned = units @ turn.T
    least = turned.min(axis=1, keepdims=True)
    # At most half a step off each.
    step = np.maximum((turned.max(axis=1, keepdims=True) - least) / (2**_PLANES - 1), 1e-12)
    rounded = np.rint((turned - least) / step)
    off = np.abs(turned - (rounded * step + least)).sum(axis=1) / np.sqrt(units.shape[1])
    return {
        "single": units.astype(np.float32),
        "rounded": rounded.astype(np.uint8),
        "least": least[:, 0],
        "step": step[:, 0],
        "off": off,
    }


def tables(asked: dict) -> list[np.ndarray]:
    """For each byte of a code, what each of its 256 values adds to the count of each query."""
    rounded = asked["rounded"].T.astype(np.float32)
    parts = [rounded[lo : lo + 8] for lo in range(0, len(rounded), 8)]
    return [(_BYTES[:, : len(part)] @ part).astype(np.uint16) for part in parts]


def _count(adds: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Sums of rounded components over set bits (vectors x queries)."""
    kind = np.uint16 if len(adds) * 8 * (2**_PLANES - 1) < 2**16 else np.uint32
    over_set = adds[0].take(columns[0], axis=0).astype(kind, copy=False)
    more = np.empty(over_set.shape, np.uint16)
    for table, column in zip(adds[1:], columns[1:], strict=True):
        table.take(column, axis=0, out=more, mode="clip")
        over_set += more
    return over_set


def _slack(width: int) -> float:
    """More than sums in single precision round off."""
    return 2.0**-19 * np.sqrt(width) + 2.0**-23 * (width + 4)


def prepare(codes: dict, width: int, epsilon: float) -> dict:
    """What a block's codes bring to each meeting."""
    return {
        "columns": codes["bits"].view(np.uint8)[:, : -(-width // 8)].T.astype(np.intp),
        "set": np.bitwise_count(codes["bits"]).sum(axis=1, dtype=np.int64),
        "scale": np.maximum(codes["length"] / codes["own"], 1e-12),
        "spread": np.sqrt(np.maximum(1 - codes["own"] ** 2, 0)) * epsilon / np.sqrt(max(width - 1, 1)),
        "centre": codes["centre"],
    }


def bounds(codes: dict, queries: np.ndarray, turn: np.ndarray, epsilon: float):
    """Estimated cosines (queries x vectors) and the half width of their bounds."""
    width, asked = queries.shape[1], ask(queries, turn)
    coded = prepare(codes, width, epsilon)
    step, least, off = (asked[n][:, None] for n in ("step", "least", "off"))
    # The code is +-1/sqrt(width): twice the sum over set bits, less the sum over all.
    sums = _count(tables(asked), coded["columns"]).T * step + coded["set"] * least
    total = asked["rounded"].sum(axis=1, dtype=np.int64, keepdims=True) * step + width * least
    estimate = (queries @ coded["centre"])[:, None] + (2 * sums - total) / np.sqrt(width) * coded["scale"]
    return estimate, (coded["spread"] + off) * coded["scale"] + 1e-9


def fewest(coded: dict, asked: dict, bar: np.ndarray) -> np.ndarray:
    """The count from which on the upper bound reaches the bar of a query (vectors x queries).

    `bounds` solved for the count, as one product of four terms of the vector and of the query.
    """
    width = asked["rounded"].shape[1]
    one = 2 * asked["step"] / np.sqrt(width)
    total = asked["rounded"].sum(axis=1, dtype=np.int64) * asked["step"] + width * asked["least"]
    gap = bar - asked["single"] @ coded["centre"] - _slack(width)
    of_query = [gap, -2 * asked["least"] / np.sqrt(width), total / np.sqrt(width) - asked["off"], -np.ones(len(gap))]
    of_code = [1 / coded["scale"], coded["set"], np.ones(len(coded["set"])), coded["spread"]]
    return np.stack(of_code, axis=1).astype(np.float32) @ (np.stack(of_query) / one).astype(np.float32)


def exact_cosine(a: dict, i: np.ndarray, b: dict, j: np.ndarray) -> np.ndarray:
    """Cosine of rows i of one block and j of another in double precision."""
    out = np.empty(len(i))
    most = max(1, 2**21 // a["data"].shape[1])
    for lo in range(0, len(i), most):
        p, q = i[lo : lo + most], j[lo : lo + most]
        dots = np.einsum("ij,ij->i", a["data"][p], b["data"][q])
        out[lo : lo + most] = dots / (a["norm"][p] * b["norm"][q])
    return out


def search_block(block: dict, asked: dict, adds: list[np.ndarray], k: int) -> int:
    """Keep the best k of one block for each query in `asked`; returns how many were reranked."""
    bar, few = asked["score"][:, -1], False
    ready = np.isfinite(bar).all()
    if ready:
        chosen = _count(adds, block["columns"]) >= fewest(block, asked, bar)
        few = np.count_nonzero(chosen) <= _FEW * chosen.size
    if not few:
        near = block["single"] @ asked["single"].T
        slack = _slack(asked["single"].shape[1])
        if not ready and len(block["once"]) >= k:
            # No k found yet for some: k other ids of this block are a bar as well.
            first = near[block["once"]]
            first[block["ids"][block["once"]][:, None] == asked["ids"]] = -np.inf
            bar = np.maximum(bar, np.partition(first, len(first) - k, axis=0)[len(first) - k] - slack)
        chosen = near >= (bar - slack).astype(np.float32)
    v, q = np.divmod(np.flatnonzero(chosen), chosen.shape[1])
    other = block["ids"][v] != asked["ids"][q]
    v, q = v[other], q[other]
    _keep(asked, q, block["ids"][v], exact_cosine(asked, q, block, v), k)
    return len(v)


def _keep(asked: dict, q: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> None:
    """The k best of each query so far, from the k best rows of one block; an id counts once."""
    last, bar = asked["found"][q, -1], asked["score"][q, -1]
    may = (score > bar) | (score == bar) & (found < last)
    q, found, score = _first(q[may], found[may], score[may], k)[:3]
    if not len(q):
        return
    met, q = np.unique(q, return_inverse=True)
    q = np.concatenate([q, np.repeat(np.arange(len(met)), k)])
    found = np.concatenate([found, asked["found"][met].ravel()])
    score = np.concatenate([score, asked["score"][met].ravel()])
    order = np.lexsort((-score, found, q))
    order = order[score[order] > -np.inf]
    q, found, score = q[order], found[order], score[order]
    once = np.ones(len(q), bool)
    once[1:] = (q[1:] != q[:-1]) | (found[1:] != found[:-1])
    q, found, score, place = _first(q[once], found[once], score[once], k)
    best = np.zeros((len(met), k), np.int64), np.full((len(met), k), -np.inf)
    best[0][q, place], best[1][q, place] = found, score
    asked["found"][met], asked["score"][met] = best


def _first(q: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first k of each query by score, then id, and their places."""
    order = np.lexsort((found, -score, q))
    q, found, score = q[order], found[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    kept = place < k
    return q[kept], found[kept], score[kept], place[kept]


def _bytes(matrix: np.ndarray) -> bytes:
    """A matrix in single precision if that is all of it, else in double precision."""
    single = matrix.astype(np.float32)
    return (single if (single == matrix).all() else matrix).tobytes()


def _block(held: dict, width: int) -> dict:
    """Ids, vectors and norms of a block as it was packed."""
    ids = np.frombuffer(held["ids"], np.int64)
    kind = np.float32 if len(held["data"]) == 4 * width * len(ids) else np.float64
    data = np.frombuffer(held["data"], kind).reshape(-1, width).astype(np.float64)
    return {"ids": ids, "data": data, "norm": np.linalg.norm(data, axis=1)}


def _pack(width: int, rows: int, key: str = "", turn: np.ndarray | None = None):
    """Rows to blocks of at most `rows` vectors that agree in length and in `key`; encoded by `turn`."""

    def block(group: tuple, ids: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
        values = [pa.array([ids.tobytes()], pa.binary()), pa.array([_bytes(matrix)], pa.binary())]
        values.insert(0, pa.array([group[0]], pa.int32()))
        names = ["dim", "ids", "data"]
        if turn is not None:
            coded = encode(unit_rows(matrix), turn)
            values += [pa.array([x.tobytes()], pa.binary()) for x in coded.values()]
            names += list(coded)
        if key:
            values.append(pa.array([group[1]], pa.int32()))
            names.append(key)
        return pa.RecordBatch.from_arrays(values, names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            keys = batch.column(key).to_numpy(zero_copy_only=False) if key else np.zeros_like(dims)
            matrix = balanced(as_matrix(batch.column("vector"), width))
            for group in {(int(d), int(x)) for d, x in zip(dims, keys, strict=True)}:
                mine = (dims == group[0]) & (keys == group[1])
                i, m = ids[mine], matrix[mine]
                if group in held:
                    i, m = (np.concatenate(pair) for pair in zip(held.pop(group), (i, m), strict=True))
                whole = len(i) // rows * rows
                for lo in range(0, whole, rows):
                    yield block(group, i[lo : lo + rows], m[lo : lo + rows])
                if whole < len(i):
                    held[group] = (i[whole:], m[whole:])
        for group, (i, m) in held.items():
            yield block(group, i, m)

    return pack


def _search(k: int, width: int, turn: np.ndarray, epsilon: float):
    """Blocks of queries, then blocks of vectors, to the k best of each query."""

    def query_block(held: dict) -> dict:
        own = _block(held, width)
        best = {"found": np.zeros((len(own["ids"]), k), np.int64), "score": np.full((len(own["ids"]), k), -np.inf)}
        return own | ask(unit_rows(own["data"]), turn) | best

    def vector_block(held: dict) -> dict:
        own = _block(held, width)
        codes = {n: np.frombuffer(held[n]) for n in ("length", "own", "centre")}
        codes["bits"] = np.frombuffer(held["bits"], np.uint64).reshape(len(own["ids"]), -1)
        own["once"] = np.unique(own["ids"], return_index=True)[1]
        own["single"] = unit_rows(own["data"]).astype(np.float32)
        return own | prepare(codes, width, epsilon * _SHARPER)

    def meet(asked: list[dict], blocks: list[dict]) -> None:
        for queries in asked:
            for lo in range(0, len(queries["ids"]), _COUNTED):
                part = {n: x[lo : lo + _COUNTED] for n, x in queries.items()}
                adds = tables(part)
                for block in blocks:
                    search_block(block, part, adds, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list] = {}  # by length of the vectors
        waiting: dict[int, list] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                held = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                dim = held["dim"]
                if held["bits"] is None:
                    asked.setdefault(dim, []).append(query_block(held))
                elif dim in asked:
                    waiting.setdefault(dim, []).append(vector_block(held))
                    if sum(len(x["ids"]) for x in waiting[dim]) >= _WAITING:
                        meet(asked[dim], waiting.pop(dim))
        for dim, blocks in waiting.items():
            meet(asked[dim], blocks)
        for queries in (x for blocks in asked.values() for x in blocks):
            row, place = np.nonzero(queries["score"] > -np.inf)
            best = queries["ids"][row], queries["found"][row, place], queries["score"][row, place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in best], names=["query_id", "vec_id", "score"]
            )

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    epsilon: float = 3.0,
    block_rows: int = 1024,
    query_rows: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of `vectors` for each row of `queries`.

    Nearness is the cosine in double precision; ties go to the smaller id; fewer rows come back
    where there are fewer candidates.  Vectors that are null, zero, empty or hold null or
    non-finite components, and rows without an id, take no part; vectors of another length are
    no candidates.  A query's own id is no candidate; rows that repeat an id count once, with
    their best score.  `epsilon` widens the error bound: 3.0 loses next to nothing.

    Every block of vectors meets every query in a task of bounded size.  Tasks form a grid: a row
    holds so many blocks of queries as stay small, mostly all, and its lanes share out the blocks
    of vectors, so vectors travel once for each row and queries once for each lane.
    """
    rows, asked = (usable(x, id_col, vector_col) for x in (vectors, queries))
    widest, n_rows = rows.agg(F.max("dim"), F.count("*")).first()
    width = max(widest or 0, 1)
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(1, -(-asked.count() // query_rows))
    # Blocks of queries that a task holds.
    together = max(1, _HELD // (width * query_rows))
    grid = -(-n_blocks // together)
    lanes = max(1, min(-(-partitions // grid), -(-n_rows // (4 * block_rows))))
    turn = rotation(width, seed)
    place = F.monotonically_increasing_id()
    packed = (
        rows.mapInArrow(_pack(width, block_rows, turn=turn), _CODED)
        # Dealt out in turn, by each task from another lane on.
        .withColumn("lane", F.pmod(place.bitwiseAND(2**33 - 1) + F.shiftright(place, 33) * 7, F.lit(lanes)))
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    )
    asked_blocks = (
        asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
        .repartition(min(n_blocks, partitions), "block")
        .mapInArrow(_pack(width, query_rows, "block"), _BLOCK + ", block int")
        .withColumn("row", F.floor(F.col("block") / together).cast("int"))
        .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
        .drop("block")
    )
    # A stated query set against all rows: each block meets each query once, in bounded tasks.
    met = (
        packed.unionByName(asked_blocks, allowMissingColumns=True)
        .repartitionById(grid * lanes, (F.col("row") * lanes + F.col("lane")).cast("int"))
        .sortWithinPartitions(F.col("bits").isNotNull())
        .drop("row", "lane")
    )
    best = met.mapInArrow(
        _search(k, width, turn, epsilon), "query_id long, vec_id long, score double"
    )
    merged = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
