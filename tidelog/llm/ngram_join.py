"""Jaccard join of word n-gram sets by vertical partitioning.

The global order of n-grams is the order of their hashes.  Cut into F ranges it cuts every
document's set into F fragments, and a pair's overlap is the sum of its fragments' overlaps.

Candidates.  Two sets with Jaccard at least t differ in at most D = (1-t)/(1+t) * (|a|+|b|)
n-grams.  A differing n-gram spoils one fragment, so if one of the sets has more than D fragments
that are not empty, some fragment is equal in both and not empty.  Fragments as tokens differ in
at most D on each side, so by the prefix principle it is enough that each document shows its
first D+1 fragments in an order common to all (those with most n-grams first, then by value).
F follows the size class of the larger set; a smaller set shows the cuts of every class that a
partner may have.  A set with too few non-empty fragments shows the cut of a second order as well
(another hash), and so on; after the last it shows single n-grams.  Nothing at or above t is lost.

Verification.  Per vertical partition the overlap of each candidate pair is counted on its
fragment alone; the counts are summed per pair and compared as whole numbers.

Only classes matter: equal sets are one node, candidates first meet the smallest node of their
fragment, and only pairs that are still in different components meet in the end.  Before
a pair is counted its parity sketches are compared: bit h mod 512 is the parity of the n-grams
with that hash, so sketches never differ in more bits than the sets do in n-grams.
"""

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm import textscan as ts
from tidelog.llm.components import connected_components
from tidelog.sources.scratch import durable

_ORDERS = 4
_SALTS = 32
#: A mark on more rows than this is hot.
_HOT = 2000
_SKETCH = [f"s{i}" for i in range(8)]
_U = np.uint64


def _salt(number: int) -> np.uint64:
    return _U(number * 0x2545F4914F6CDD1D % 2**64)


def _word_hashes(block: ts.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the block and the row it is in; A to Z in lower case."""
    codes = block.codes.copy()
    if not len(codes):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    codes[(codes >= 0x41) & (codes <= 0x5A)] += 0x20
    gap = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
    start = ts.row_starts(block)
    start[1:] |= gap[1:] != gap[:-1]
    begins = np.flatnonzero(start)
    words = ~gap[begins]
    hashes = ts.hash_spans(codes, begins)[words]
    row = np.searchsorted(block.bounds, begins[words], "right") - 1
    return hashes, row


def ngram_sets(block: ts.Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all rows, sorted within each, and the bounds of each row.

    A row with fewer than n words, but some, has its whole sequence as its only n-gram.
    """
    words, row = _word_hashes(block)
    per_row = np.bincount(row, minlength=block.rows)
    first = np.cumsum(per_row) - per_row
    length = np.minimum(per_row, n)
    grams = np.where(per_row >= n, per_row - n + 1, np.minimum(per_row, 1))
    of_row = np.repeat(np.arange(block.rows), grams)
    at = ts.ragged(first, grams)
    value = np.full(len(at), _U(n)) + length[of_row].astype(_U)
    for i in range(n):
        inside = i < length[of_row]
        step = np.where(inside, words[np.minimum(at + i, max(len(words) - 1, 0))], _U(0)) if len(words) else value
        value = np.where(inside, ts.mix(value * _U(0x9E3779B97F4A7C15) + step), value)
    order = np.lexsort((value, of_row))
    value, of_row = value[order], of_row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of_row[1:] != of_row[:-1])
    value, of_row = value[new], of_row[new]
    return value, np.searchsorted(of_row, np.arange(block.rows + 1))


class Shape:
    """Whole-number bounds for one threshold t = num / den."""

    def __init__(self, threshold: Fraction):
        self.num, self.den = threshold.numerator, threshold.denominator

    def differing(self, total: int) -> int:
        """Most n-grams in which two sets of at most `total` together can differ at Jaccard >= t.

        They differ in (1 - Jaccard) of their union, which is total / (1 + Jaccard).
        """
        return (self.den - self.num) * total // (self.den + self.num)

    def largest_partner(self, size: int) -> int:
        return size * self.den // self.num

    def size_class(self, size: int) -> int:
        """Classes are powers of two."""
        return size.bit_length() - 1

    def cut(self, size_class: int) -> int:
        """Number of fragments for pairs whose larger set is in the class."""
        most = self.differing(2 * ((2 << size_class) - 1))
        return 1 if most == 0 else most + most // 6 + 2


def _fragments(grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fragment number of each n-gram (sorted input), by equal ranges of the hash order."""
    return ((grams >> _U(32)) * _U(n)) >> _U(32)


def signatures(grams: np.ndarray, shape: Shape) -> np.ndarray:
    """What a set shows, as 64-bit values: equal non-empty fragments show the same value."""
    size = len(grams)
    if not size:
        return np.zeros(0, _U)
    out = []
    for group in range(shape.size_class(size), shape.size_class(shape.largest_partner(size)) + 1):
        larger = min(shape.largest_partner(size), (2 << group) - 1)
        most = shape.differing(size + larger)
        cut = shape.cut(group)
        for turn in range(_ORDERS + 1):
            seed = group * 64 + turn
            if turn == _ORDERS:  # every order failed: single n-grams, the first D+1
                shown = np.sort(ts.mix(grams))[: most + 1]
                out.append(ts.mix(shown + _salt(seed)))
                break
            keys = grams if turn == 0 else np.sort(ts.mix(grams + _U(seed)))
            number = _fragments(keys, cut)
            starts = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            content = np.add.reduceat(ts.mix(keys), starts)
            value = ts.mix(content + ts.mix(number[starts] + _salt(seed)))
            # The common order of fragments: those with most n-grams first, they tell most.
            many = np.diff(np.append(starts, len(keys)))
            out.append(value[np.lexsort((value, -many))[: most + 1]])
            if len(starts) > most:
                break
    return np.unique(np.concatenate(out))


def sketches(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Parity sketch of every row, as eight 64-bit columns."""
    rows = len(bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))
    bit = (grams & _U(511)).astype(np.int64)
    odd = np.bincount(row * 512 + bit, minlength=rows * 512).astype(np.uint8) & 1
    return np.packbits(odd.reshape(rows, 512), axis=1).view(np.int64)


def _profile(n: int):
    """Size, name and sketch of every text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.each(batches):
            for block in ts.blocks(batch.column("text")):
                grams, bounds = ngram_sets(block, n)
                sketch = sketches(grams, bounds)
                columns = [
                    batch.column("id").slice(block.first_row, block.rows),
                    *(pa.array(x) for x in (np.diff(bounds).astype(np.int64), *_set_keys(grams, bounds))),
                    *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(8)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "k1", "k2", *_SKETCH])

    return run


def _show(shape: Shape, n: int):
    """What every text's set shows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.each(batches):
            for block in ts.blocks(batch.column("text")):
                grams, bounds = ngram_sets(block, n)
                shown = [signatures(grams[a:b], shape) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                counts = np.array([len(x) for x in shown], np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                flat = np.concatenate(shown).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(block.first_row, block.rows),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(flat)),
                    ],
                    names=["id", "n", "shown"],
                )

    return run


def _set_keys(grams: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each row's n-grams: with the size, the name of a set."""
    full = np.flatnonzero(np.diff(bounds))
    keys = []
    for salt in (0, 0x5851F42D4C957F2D):
        total = np.zeros(len(bounds) - 1, _U)
        if len(full):
            total[full] = np.add.reduceat(ts.mix(grams + _U(salt)), bounds[:-1][full])
        keys.append(total.view(np.int64))
    return keys


def _vertical(n: int, parts: int):
    """Sets cut into `parts` vertical partitions: id, part, grams.

    Of rows that repeat an id only the one with the expected set counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.each(batches):
            expected = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "k1", "k2")]
            for block in ts.blocks(batch.column("text")):
                grams, bounds = ngram_sets(block, n)
                rows = slice(block.first_row, block.first_row + block.rows)
                found = [np.diff(bounds), *_set_keys(grams, bounds)]
                wanted = np.logical_and.reduce(
                    [x == y[rows] for x, y in zip(found, expected, strict=True)]
                )
                row = np.repeat(np.arange(block.rows), np.diff(bounds))
                grams, row = grams[wanted[row]], row[wanted[row]]
                part = _fragments(grams, parts).astype(np.int64)
                new = np.ones(len(grams), bool)
                new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
                starts = np.flatnonzero(new)
                offsets = pa.array(np.append(starts, len(grams)).astype(np.int32))
                ids = batch.column("id").slice(block.first_row, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row[starts])),
                        pa.array(part[starts].astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, pa.array(grams.view(np.int64))),
                    ],
                    names=["id", "part", "grams"],
                )

    return run


def _alike(shape: Shape, a: str, b: str) -> Column:
    """False only for pairs that sizes or sketches rule out; columns carry the prefixes a and b."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    fits = F.least(na, nb) * shape.den >= F.greatest(na, nb) * shape.num
    bits = sum(
        (F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in _SKETCH[1:]),
        F.bit_count(F.col(f"{a}s0").bitwiseXOR(F.col(f"{b}s0"))),
    )
    # Most differing n-grams: total - 2 * ceil(num * total / (num + den)).
    total = na + nb
    least = F.floor((total * shape.num + shape.num + shape.den - 1) / (shape.num + shape.den))
    return fits & (bits <= total - 2 * least)


def _verified(pairs: DataFrame, cut: DataFrame, shape: Shape) -> DataFrame:
    """The pairs (a, b, an, bn) that reach the threshold, by overlaps summed over partitions."""
    left = cut.select(F.col("id").alias("a"), "part", F.col("grams").alias("x"))
    right = cut.select(F.col("id").alias("b"), "part", F.col("grams").alias("y"))
    overlap = (
        pairs.join(left, "a")
        .join(right, ["b", "part"])
        .select("a", "b", "an", "bn", F.size(F.array_intersect("x", "y")).cast("long").alias("common"))
        .groupBy("a", "b", "an", "bn")
        .agg(F.sum("common").alias("common"))
    )
    union = F.col("an") + F.col("bn") - F.col("common")
    return overlap.where(F.col("common") * shape.den >= union * shape.num).select("a", "b")


def similar_classes(
    docs: DataFrame,
    n: int = 5,
    threshold: str = "0.8",
    id_col: str = "doc_id",
    text: str = "text",
    parts: int = 8,
) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of `docs`.

    Texts are lower-cased (A to Z) and cut into words at blanks and control characters 9 to 13;
    a set is the distinct n-grams, or the whole sequence where there are fewer words.  Two
    documents link when overlap / union is at least `threshold`, compared as whole numbers.
    component_id is the smallest id reachable by links, the own one included.  Null, empty and
    wordless texts have an empty set and link with nothing.  Rows without an id have a null
    component and link with nothing; rows that repeat an id are one document, whose set is that
    of the row with the most n-grams.
    """
    shape = Shape(Fraction(threshold))
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    profiles = durable(
        ids.mapInArrow(
            _profile(n),
            "id long, n long, k1 long, k2 long, " + ", ".join(f"{s} long" for s in _SKETCH),
        )
    )
    # One set per id, one node per set: partial aggregation meets a hot set in every task.
    key = ["n", "k1", "k2"]
    chosen = durable(
        profiles.where("id IS NOT NULL AND n > 0")
        .groupBy("id")
        .agg(F.max(F.struct(*key)).alias("k"))
        .select("id", "k.*")
    )
    # Sets that several ids share, repeated for every salt: the ids of one set, maybe a third of
    # all, are dealt out over as many join keys.
    several = (
        chosen.groupBy(*key)
        .agg(F.min("id").alias("of"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(*key, "of", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    )
    salted = chosen.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int"))
    member = durable(
        salted.join(several, [*key, "salt"], "left").select("id", F.coalesce("of", "id").alias("of"))
    )
    # Small tables are written before they are joined with: Spark then knows their size, and
    # texts stay where they are while it can broadcast them.
    copies = durable(member.where("id <> of").select("id"))
    shown = (
        ids.where("id IS NOT NULL")
        .join(copies, "id", "left_anti")
        .mapInArrow(_show(shape, n), "id long, n long, shown array<long>")
        .select("id", "n", F.explode("shown").alias("mark"))
    )
    # Only neighbours in size can be partners.  Per mark the classes of sizes are counted, combined
    # on the map side; partners are in one class or in two that lie side by side.
    width = -math.log(shape.num / shape.den) * (1 + 1e-9) if shape.num < shape.den else 1e-9
    shown = durable(shown.withColumn("class", F.floor(F.log("n") / width)))
    classes = shown.groupBy("mark", "class").agg(F.count(F.lit(1)).alias("many"))
    by_class = Window.partitionBy("mark").orderBy("class")  # at most one row per class
    beside = (F.lead("class").over(by_class) == F.col("class") + 1) | (
        F.lag("class").over(by_class) == F.col("class") - 1
    )
    kept = durable(
        classes.withColumn("beside", F.coalesce(beside, F.lit(False)))
        .where("beside OR many > 1")
        .select("mark", "class", "many")
    )
    # Marks on many rows: one in _HOT rows at most.  Their rows are dealt out over salts, and what
    # is known of the mark is repeated for each.
    hot = durable(
        kept.groupBy("mark").agg(F.sum("many").alias("rows")).where(F.col("rows") > _HOT).select("mark")
    )
    salt = F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int")
    marked = hot.select("mark", F.lit(True).alias("hot"))
    shown = shown.join(marked, "mark", "left").withColumn("salt", F.when(F.col("hot"), salt).otherwise(0))

    def for_salts(table: DataFrame) -> DataFrame:
        """A table with one row per mark (and class), repeated for the salts of hot marks."""
        all_salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
        return table.join(marked, "mark", "left").withColumn("salt", F.explode(all_salts)).drop("hot")

    marks = durable(
        shown.drop("n", "hot")
        .join(for_salts(kept.select("mark", "class")), ["mark", "class", "salt"], "left_semi")
        .select("mark", "salt", "id")
    )
    groups = for_salts(marks.groupBy("mark").agg(F.min("id").alias("centre")))
    nodes = durable(marks.select("id").distinct())
    own = chosen.join(nodes, "id", "left_semi")
    facts = durable(
        profiles.join(nodes, "id", "left_semi")
        .join(own, ["id", *key], "left_semi")
        .dropDuplicates(["id"])
    )

    def side(prefix: str) -> DataFrame:
        return facts.select(F.col("id").alias(prefix), *(F.col(c).alias(prefix + c) for c in ("n", *_SKETCH)))

    def sets_of(pairs: DataFrame) -> DataFrame:
        """The sets of all members of `pairs`, cut; texts are read once more for them."""
        asked = durable(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        return durable(
            ids.join(asked, "id", "left_semi")
            .join(facts.select("id", *key), "id")
            .mapInArrow(_vertical(n, parts), "id long, part int, grams array<long>")
            .dropDuplicates(["id", "part"])
        )

    alike = _alike(shape, "a", "b")
    stars = durable(
        marks.join(groups, ["mark", "salt"])
        .where("id <> centre")
        .select(F.col("centre").alias("a"), F.col("id").alias("b"))
        .distinct()
        .join(side("a"), "a")
        .join(side("b"), "b")
        .where(alike)
        .select("a", "b", "an", "bn")
    )
    links = durable(_verified(stars, sets_of(stars), shape))
    so_far = durable(connected_components(links))
    # Marks whose nodes are not in one component yet.  Within each the largest component is
    # not compared with itself: the others meet everyone of another component.
    placed = durable(
        marks.join(so_far, F.col("id") == F.col("node"), "left").select(
            "mark", "salt", "id", F.coalesce("component", "id").alias("c")
        )
    )
    tally = placed.groupBy("mark", "c").agg(F.count(F.lit(1)).alias("size"))
    mixed = tally.groupBy("mark").agg(
        F.max_by("c", F.struct("size", "c")).alias("main"), F.count(F.lit(1)).alias("many")
    ).where("many > 1")
    open_marks = durable(
        placed.join(for_salts(mixed.select("mark", "main")), ["mark", "salt"]).join(facts.drop("k1", "k2"), "id")
    ).join(marked, "mark", "left")
    columns = ("id", "c", "n", *_SKETCH)
    # Blocks of a hot mark, one per salt, meet in pairs: each side goes to all blocks of the other.
    all_blocks = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    one = open_marks.where("c <> main").select(
        F.col("mark").alias("amark"), F.col("salt").alias("asalt"), F.explode(all_blocks).alias("aother"),
        *(F.col(c).alias("a" + c) for c in columns),
    )
    other = open_marks.select(
        F.col("mark").alias("bmark"), F.col("salt").alias("bsalt"), F.explode(all_blocks).alias("bother"),
        "main", *(F.col(c).alias("b" + c) for c in columns),
    )
    met = (F.col("amark") == F.col("bmark")) & (F.col("asalt") == F.col("bother")) & (F.col("aother") == F.col("bsalt"))
    once = (F.col("ac") < F.col("bc")) | ((F.col("bc") == F.col("main")) & (F.col("ac") > F.col("bc")))
    rest = (
        one.join(other, met & once & alike)
        .select(
            F.least("aid", "bid").alias("a"),
            F.greatest("aid", "bid").alias("b"),
            F.when(F.col("aid") < F.col("bid"), F.col("an")).otherwise(F.col("bn")).alias("an"),
            F.when(F.col("aid") < F.col("bid"), F.col("bn")).otherwise(F.col("an")).alias("bn"),
        )
        .distinct()
    )
    rest = durable(rest)
    more = _verified(rest, sets_of(rest), shape)
    final = connected_components(links.union(more))
    component = member.join(final, F.col("of") == F.col("node"), "left").select(
        "id", F.coalesce("component", "of").alias("component")
    )
    return (
        profiles.select("id", "n")
        .join(component, "id", "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component_id"),
        )
    )
