"""Near-duplicate vectors by product quantisation, lossless.

Vectors are scaled to length one, where a cosine of t is a distance of sqrt(2 - 2t) = r.  Coarse
centres cut each label's vectors into inverted lists; what a list member differs from its centre
is kept as one code per subspace, with the length of what the codes leave over.

* Sufficient probes: a vector within r of x lies in the list of centre c only if x is at most r
  beyond the plane between c and its own centre.  x probes exactly those lists.
* Asymmetric distances: a table of x's distances to all codes gives its distance to the
  reconstruction of each member; less the member's left-over length it is a lower bound.
* Members whose bound is within r are compared by cosine in double precision.

Nothing within r is lost at any step, so the result is that of a comparison of all pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.components import connected_components, local_roots
from tidelog.llm.vectors import as_matrix, balanced, is_usable, kmeans, nearest, unit_rows, widest
from tidelog.sources.scratch import durable

_SLACK = 1e-6
_GROUP = ("label", "dim", "cell")


def train(sample: np.ndarray, lists: int, subspaces: int, codes: int, seed: int = 7) -> dict:
    """Coarse centres and, on their residuals, one codebook per subspace."""
    centres = kmeans(sample, lists, 8, seed)
    residual = sample - centres[nearest(sample, centres)]
    parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
    books = [kmeans(residual[:, p], codes, 6, seed + 1 + i) for i, p in enumerate(parts)]
    return {"centres": centres, "parts": parts, "books": books}


def quantise(units: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own list, codes, and the length that the codes leave over, of each vector."""
    cell = nearest(units, model["centres"])
    residual = units - model["centres"][cell]
    codes = np.stack(
        [nearest(residual[:, p], b) for p, b in zip(model["parts"], model["books"], strict=True)], axis=1
    )
    left = residual.copy()
    for i, (p, b) in enumerate(zip(model["parts"], model["books"], strict=True)):
        left[:, p] -= b[codes[:, i]]
    return cell, codes.astype(np.uint8), np.linalg.norm(left, axis=1)


def probes(units: np.ndarray, cell: np.ndarray, model: dict, radius: float):
    """(row, list) of every list that may hold something within the radius of the row."""
    centres = model["centres"]
    squares = (centres**2).sum(1)
    far = squares - 2 * units @ centres.T
    lead = far - far[np.arange(len(units)), cell][:, None]
    gaps = np.sqrt(np.maximum(squares[:, None] + squares - 2 * centres @ centres.T, 0))
    return np.nonzero(lead <= 2 * gaps[cell] * (radius + _SLACK) + _SLACK)


def table_distances(query: np.ndarray, codes: np.ndarray, centre: np.ndarray, model: dict) -> np.ndarray:
    """Distance of each query to the reconstruction of each list member, by table look-up."""
    residual = query - centre
    total = np.zeros((len(query), len(codes)))
    for i, (p, book) in enumerate(zip(model["parts"], model["books"], strict=True)):
        own = residual[:, p]
        table = (own**2).sum(1)[:, None] - 2 * own @ book.T + (book**2).sum(1)
        total += table[:, codes[:, i]]
    return np.sqrt(np.maximum(total, 0))


def _assign(model: dict, width: int):
    """Own list, codes and left-over length of every vector, the vector as packed doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = balanced(as_matrix(batch.column("vector"), width))
            cell, codes, left = quantise(unit_rows(matrix), model)
            kept = {n: batch.column(n) for n in ("id", "label", "dim", "copies")}
            new = {
                "cell": pa.array(cell.astype(np.int32)),
                "vector": pa.array([v.tobytes() for v in matrix], pa.binary()),
                "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                "left": pa.array(left),
            }
            yield pa.RecordBatch.from_arrays([*kept.values(), *new.values()], names=[*kept, *new])

    return run


_BLOCK = (
    "block string, label string, dim int, cell int, reach array<int>, "
    "ids binary, copies binary, vectors binary, codes binary, lefts binary"
)


def _pack(model: dict, width: int, radius: float):
    """Members of one block of a list as one row, with the lists that any of them probes."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        label, dim, cell, number = (k.as_py() for k in key)
        vectors = b"".join(rows.column("vector").to_pylist())
        units = unit_rows(np.frombuffer(vectors).reshape(-1, width))
        _, probed = probes(units, np.full(len(units), cell), model, radius)
        binary = lambda name: [rows.column(name).to_numpy().tobytes()]
        return pa.table(
            {
                "block": [f"{label}/{dim}/{cell}/{number}"],
                "label": [label],
                "dim": pa.array([dim], pa.int32()),
                "cell": pa.array([cell], pa.int32()),
                "reach": pa.array([np.unique(probed)], pa.list_(pa.int32())),
                "ids": pa.array(binary("id"), pa.binary()),
                "copies": pa.array(binary("copies"), pa.binary()),
                "vectors": pa.array([vectors], pa.binary()),
                "codes": pa.array([b"".join(rows.column("codes").to_pylist())], pa.binary()),
                "lefts": pa.array(binary("left"), pa.binary()),
            }
        )

    return run


def compare_blocks(a: dict, b: dict, model: dict, threshold: float):
    """(row of a, row of b) of all links between two blocks; within one block, each pair once."""
    radius = np.sqrt(2 - 2 * threshold)
    rows = []
    for own, other in ((a, b), (b, a)):
        # Only rows that are near enough to the other block's list can have a partner in it.
        lead = probes(own["units"], np.full(len(own["units"]), own["cell"]), model, radius)
        rows.append(lead[0][lead[1] == other["cell"]])
    i, j = rows
    if not len(i) or not len(j):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    distance = table_distances(a["units"][i], b["codes"][j], model["centres"][b["cell"]], model)
    near = distance - b["lefts"][j][None] <= radius + _SLACK
    if a["block"] == b["block"]:
        near &= i[:, None] < j[None]
    u, v = np.nonzero(near)
    u, v = i[u], j[v]
    linked = np.zeros(len(u), bool)
    for lo in range(0, len(u), 32768):
        x, y = a["vectors"][u[lo : lo + 32768]], b["vectors"][v[lo : lo + 32768]]
        dots = np.einsum("ij,ij->i", x, y)
        norms = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
        linked[lo : lo + 32768] = dots / norms >= threshold
    linked &= a["ids"][u] != b["ids"][v]
    return u[linked], v[linked]


def _compare(model: dict, width: int, threshold: float):
    def block(batch: pa.RecordBatch, row: int, side: str) -> dict:
        get = lambda name: batch.column(f"{side}_{name}")[row].as_py()
        vectors = np.frombuffer(get("vectors")).reshape(-1, width)
        return {
            "block": get("block"),
            "cell": get("cell"),
            "ids": np.frombuffer(get("ids"), np.int64),
            "copies": np.frombuffer(get("copies"), np.int64),
            "lefts": np.frombuffer(get("lefts")),
            "codes": np.frombuffer(get("codes"), np.uint8).reshape(len(vectors), -1),
            "vectors": vectors,
            "units": unit_rows(vectors),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = (block(batch, row, side) for side in "ab")
                u, v = compare_blocks(a, b, model, threshold)
                if not len(u):
                    continue
                # The links leave as counts and a forest: one row per vector, not per link.
                nodes, index = np.unique(np.concatenate([a["ids"], b["ids"]]), return_inverse=True)
                left, right = index[u], index[len(a["ids"]) + v]
                count = np.zeros(len(nodes), np.int64)
                np.add.at(count, left, b["copies"][v])
                np.add.at(count, right, a["copies"][u])
                root = local_roots(left, right, len(nodes))
                some = count > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[some]) for x in (nodes, nodes[root], count)],
                    names=["id", "root", "n_links"],
                )

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    subspaces: int = 8,
    codes: int = 64,
    sample_rows: int = 8192,
    list_rows: int = 2048,
    max_lists: int = 1024,
    block_rows: int = 2048,
    seed: int = 7,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of `vectors`.

    Two rows with equal, non-null labels link when their cosine is at least `threshold`.
    n_links counts the other rows linked directly, copies included.  Vectors that are null,
    empty, zero or hold null or non-finite components, vectors of different lengths and rows
    without a label link with nothing and are components of their own; without an id the
    component is null and the row is kept.  Rows that repeat an id are one node: they share a
    component, and the links of all of them are counted for each.

    The centres and codebooks are fitted on at most `sample_rows` rows (those with the smallest
    hash); every row is indexed and searched.  `block_rows` bounds what is compared at once:
    longer lists are cut into blocks, and blocks meet in pairs, each pair once.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & is_usable("vector")
    hashed = [F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2")]
    rows = source.select(
        "id", "label", "vector", F.coalesce(fit, F.lit(False)).alias("fit"), *hashed
    )
    # Equal vectors are one: a partial minimum and count per task, whatever the number of copies.
    classes = durable(
        rows.where("fit")
        .groupBy("label", "h1", "h2")
        .agg(
            F.min("id").alias("id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vector").alias("vector"),
        )
        .withColumn("dim", F.size("vector"))
    )
    width = widest(classes)
    tally = rows.select("id", "label", "h1", "h2", "fit")
    if not width:
        linked = None
    else:
        n = classes.count()
        sample = (
            classes.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample_rows).select("vector").toArrow()
        )
        lists = int(min(max_lists, max(4, n // list_rows)))
        model = train(unit_rows(as_matrix(sample.column("vector"), width)), lists, subspaces, codes, seed)
        radius = float(np.sqrt(2 - 2 * threshold))
        assigned = durable(
            classes.select("id", "label", "dim", "copies", "vector").mapInArrow(
                _assign(model, width),
                "id long, label string, dim int, copies long, cell int, "
                "vector binary, codes binary, left double",
            )
        )
        sizes = assigned.groupBy(*_GROUP).agg(
            F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")
        )
        number = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("number")
        blocks = durable(
            assigned.join(sizes, list(_GROUP))
            .select(*_GROUP, number, "id", "copies", "vector", "codes", "left")
            .groupBy(*_GROUP, "number")
            .applyInArrow(_pack(model, width, radius), _BLOCK)
        )
        # Which blocks meet is settled on names alone: a list and the later lists it reaches.
        names = blocks.select("block", "label", "dim", "cell", "reach")
        ahead = names.select(
            F.col("block").alias("a"), "label", "dim", F.col("cell").alias("own"),
            F.explode("reach").alias("cell"),
        ).where("cell >= own")
        pairs = (
            ahead.join(names.select(F.col("block").alias("b"), "label", "dim", "cell"), ["label", "dim", "cell"])
            .where("cell > own OR a <= b")
            .select("a", "b")
        )
        fields = ("block", "cell", "ids", "copies", "vectors", "codes", "lefts")
        sides = {
            side: blocks.select(*(F.col(f).alias(f"{side}_{f}") for f in fields)) for side in "ab"
        }
        met = pairs.join(sides["a"], F.col("a") == F.col("a_block")).join(
            sides["b"], F.col("b") == F.col("b_block")
        )
        forest = durable(
            met.select(*(f"{side}_{f}" for side in "ab" for f in fields)).mapInArrow(
                _compare(model, width, threshold), "id long, root long, n_links long"
            )
        )
        counts = forest.groupBy("id").agg(F.sum("n_links").alias("far"))
        parts = connected_components(forest.select("id", "root"))
        # An id may stand for several classes when rows repeat it.
        linked = (
            classes.select("label", "h1", "h2", "id", "copies")
            .join(counts, "id", "left")
            .join(parts, F.col("id") == F.col("node"), "left")
            .select(
                "label",
                "h1",
                "h2",
                (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n"),
                F.coalesce("component", "id").alias("c"),
            )
        )
    if linked is None:
        found = tally.withColumns({"n": F.lit(None).cast("long"), "c": F.lit(None).cast("long")})
    else:
        on = [tally[k].eqNullSafe(linked[k]) if k == "label" else tally[k] == linked[k] for k in ("label", "h1", "h2")]
        found = tally.join(linked, [*on, tally["fit"]], "left").select(
            tally["id"], "n", "c"
        )
    component = F.coalesce("c", "id")
    return found.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
