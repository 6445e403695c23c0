"""Toxicity by the nearest labelled examples: TF-IDF cosine over a block-max inverted index.

Words are maximal runs of letters in lower case.  The vocabulary is what tells the classes of a
bounded sample of labelled documents apart (the G-test of a word's documents by class); how many
documents have a word is counted over all documents.  The sampled documents are the examples.  Each
word's list of examples is cut into blocks with the greatest weight of each; a text's sum of those
bounds its similarity to every example of a block, so that blocks that cannot hold a nearer one
than the k at hand are passed over and the k nearest are exact.  Similarity-weighted votes of the
nearest, turned into a probability by a logistic fit on the examples themselves, are the score; the
examples with label and similarity are its evidence.

Null, empty and wordless texts and those without a word of the vocabulary have no evidence and the
score of a vote without neighbours.  Labels that are null, neither 0 nor 1 or without id are left
out, of labels that repeat an id the greatest counts, documents that repeat an id are examples each.
Without labels of both classes the score is the share of label 1, and without any 0.5.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import textscan as ts
from tidelog.sources.scratch import durable

BLOCK = 64
NEIGHBOURS = 16
EVIDENCE = T.ArrayType(
    T.StructType(
        [
            T.StructField("doc_id", T.StringType()),
            T.StructField("label", T.IntegerType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
)


def _words(block: ts.Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word of a block."""
    codes = block.codes
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = ts.classes()[codes] == ts.LETTER
    change = ts.row_starts(block)
    change[1:] |= letter[1:] != letter[:-1]
    spans = np.flatnonzero(change)
    hashes = ts.hash_spans(ts.lower()[codes], spans)[letter[spans]]
    starts = spans[letter[spans]]
    return np.searchsorted(block.bounds, starts, "right") - 1, hashes.view(np.int64)


def _bags(block: ts.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and number of occurrences of every distinct word of each row."""
    row, hashes = _words(block)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return row[first], hashes[first], np.diff(np.append(first, len(row)))


def _lists(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.ListArray:
    ends = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


@dataclass
class Vocabulary:
    """Hashes of the chosen words, ascending, and their inverse document frequencies."""

    hashes: np.ndarray
    idf: np.ndarray

    def find(self, row: np.ndarray, hashes: np.ndarray, counts: np.ndarray):
        """The words of the vocabulary alone: row, number of the word, occurrences."""
        if not len(self.hashes):
            return row[:0], row[:0], counts[:0]
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[place] == hashes
        return row[known], place[known], counts[known]

    def weights(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF of one text's words, of length one."""
        raw = (1 + np.log(counts)) * self.idf[words]
        return raw / np.sqrt((raw * raw).sum()) if len(raw) else raw


@dataclass
class Index:
    """Block-max inverted lists of the examples; examples that are alike are neighbours in it."""

    ids: list[str]
    labels: np.ndarray
    words: int
    examples: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Where the part of each word's list in each block begins, with the end; its greatest value.
    places: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    peaks: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    @staticmethod
    def build(rows: list[tuple[str, int, np.ndarray, np.ndarray]], words: int, block: int = BLOCK) -> "Index":
        """From (id, label, words, weights) of each example."""

        def kinship(r):
            heavy = sorted(zip(-r[3], r[2], strict=True))
            return [int(w) for _, w in heavy[:4]], r[1], r[0] or ""

        rows = sorted(rows, key=kinship)
        made = Index([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), words)
        word = np.concatenate([np.zeros(0, np.int64), *[r[2] for r in rows]]).astype(np.int64)
        example = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        value = np.concatenate([np.zeros(0), *[r[3] for r in rows]])
        order = np.lexsort((example, word))
        word, made.examples, made.values = word[order], example[order], value[order]
        blocks = -(-len(rows) // block)
        edges = np.arange(words)[:, None] * (blocks + 1) + np.arange(blocks + 1)
        made.places = np.searchsorted(word * (blocks + 1) + made.examples // block, edges)
        made.peaks = np.zeros((words, blocks))
        np.maximum.at(made.peaks, (word, made.examples // block), made.values)
        return made

    def search(
        self, words: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, but: int = -1, block: int = BLOCK
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples with a similarity above zero, nearest first, ties as indexed.

        `but` is left out.  Blocks are opened by falling bound until no bound reaches the k-th.
        """
        found, near = np.zeros(0, np.int64), np.zeros(0)
        if not len(words) or not len(self.ids):
            return found, near
        bounds = weights @ self.peaks[words]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        at, step, least = 0, 4, 0.0
        # Bounds add up in another order than similarities: a little room for rounding.
        while at < len(order) and bounds[order[at]] * (1 + 1e-9) >= least:
            some = np.sort(order[at : at + step])
            some = some[bounds[some] * (1 + 1e-9) >= least]
            lo, hi = self.places[words[:, None], some], self.places[words[:, None], some + 1]
            lo, many = lo.reshape(-1), (hi - lo.reshape(hi.shape)).reshape(-1)
            at_list = ts.ragged(lo, many)
            example = self.examples[at_list]
            slot = np.searchsorted(some, example // block) * block + example % block
            sums = np.bincount(
                slot, weights=self.values[at_list] * np.repeat(np.repeat(weights, len(some)), many),
                minlength=len(some) * block,
            )
            hit = np.flatnonzero(sums > 0)
            example = some[hit // block] * block + hit % block
            other = example != but
            found = np.concatenate([found, example[other]])
            near = np.concatenate([near, sums[hit][other]])
            best = np.lexsort((found, -near))[:k]
            found, near = found[best], near[best]
            least = near[-1] if len(near) == k else 0.0
            at, step = at + step, step * 2
        return found, near


@dataclass
class Model:
    vocabulary: Vocabulary
    index: Index
    #: Vote without neighbours, its weight, and the two figures of the logistic fit.
    share: float
    slope: float = 1.0
    shift: float = 0.0
    neighbours: int = NEIGHBOURS
    constant: float | None = None

    def vote(self, found: np.ndarray, near: np.ndarray) -> float:
        """Share of label 1 among the nearest, each by its squared similarity."""
        weight = near * near
        return (weight @ self.index.labels[found] + self.share) / (weight.sum() + 1)

    def probability(self, vote: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(np.shape(vote), self.constant)
        return _sigmoid(self.slope * _logit(vote) + self.shift)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def _calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope (above zero) and shift of a logistic fit to the votes, by damped Newton steps."""
    x, beta = np.stack([_logit(votes), np.ones(len(votes))], axis=1), np.array([1.0, 0.0])
    weights = weights / weights.sum()

    def loss(b):
        z = x @ b
        return weights @ (np.logaddexp(0, z) - labels * z) + 1e-4 * ((b - [1, 0]) ** 2).sum()

    for _ in range(50):
        p = _sigmoid(x @ beta)
        slope = x.T @ (weights * (p - labels)) + 2e-4 * (beta - [1, 0])
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 2e-4 * np.eye(2)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def _g_test(ones: Column, zeros: Column, n1: int, n0: int) -> Column:
    """Evidence that a word's documents are not dealt to the classes by chance."""
    n = n1 + n0
    have = ones + zeros

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (
        term(ones, have * (n1 / n))
        + term(zeros, have * (n0 / n))
        + term(n1 - ones, (n - have) * (n1 / n))
        + term(n0 - zeros, (n - have) * (n0 / n))
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text: str = "text",
    sample_rows: int = 2000,
    most_words: int = 4096,
    least_evidence: float = 15.0,
    least_lift: float = 2.0,
    neighbours: int = NEIGHBOURS,
    seed: int = 7,
) -> Model:
    """Learn from at most `sample_rows` labelled documents of each class, those with the smallest hash of their id.

    Vocabulary: at most `most_words` words, those with the greatest G-statistic, at least
    `least_evidence`, whose share of the documents of one class is at least `least_lift` times that
    of the other.  Document frequencies are those of all `docs`.  These bounds are fixed whatever
    the corpus; texts are whole.
    """
    marked = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(id_col)
        .agg(F.max(label).cast("int").alias("__label"))
    )
    counts = {r["__label"]: r["count"] for r in marked.groupBy("__label").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    nothing = Vocabulary(np.zeros(0, np.int64), np.zeros(0))
    plain = Model(nothing, Index([], np.zeros(0, np.int64), 0), share, constant=share)
    if len(counts) < 2:
        return plain
    order = [F.xxhash64(F.col(id_col), F.lit(seed)), F.col(id_col)]
    zeros, ones = (marked.where(F.col("__label") == v).orderBy(*order).limit(sample_rows) for v in (0, 1))
    # At most 2 * sample_rows ids.
    chosen = docs.select(id_col, text).join(F.broadcast(zeros.union(ones)), id_col)
    bags = durable(chosen.mapInArrow(_encode(id_col, text), _BAGS))
    have = {r["label"]: r["count"] for r in bags.groupBy("label").count().collect()}
    if len(have) < 2:
        return plain
    n1, n0 = have[1], have[0]
    seen = bags.select("label", F.explode("hashes").alias("hash")).groupBy("hash").agg(
        F.sum("label").cast("double").alias("ones"), F.sum(1 - F.col("label")).cast("double").alias("zeros")
    )
    rates = [(F.col("ones") + 0.5) / n1, (F.col("zeros") + 0.5) / n0]
    lift = F.greatest(rates[0] / rates[1], rates[1] / rates[0])
    telling = (
        seen.withColumn("g", _g_test(F.col("ones"), F.col("zeros"), n1, n0))
        .where((F.col("g") >= least_evidence) & (lift >= least_lift))
        .orderBy(F.desc("g"), "hash")
        .limit(most_words)
    )
    hashes = np.sort(np.array([r["hash"] for r in telling.collect()], np.int64))
    n, frequency = _frequencies(docs, hashes, text)
    vocabulary = Vocabulary(hashes, np.log((n + 1) / np.maximum(frequency, 1)))
    rows = []
    for r in _known(bags, vocabulary).toLocalIterator():
        words = np.array(r["words"], np.int64)
        rows.append((r["id"], r["label"], words, vocabulary.weights(words, np.array(r["counts"]))))
    model = Model(vocabulary, Index.build(rows, len(hashes)), share, neighbours=neighbours)
    own = {r[0]: [] for r in rows}
    for i, known in enumerate(model.index.ids):
        own[known].append(i)
    # Each example's vote without itself, weighted so that the classes count as among all labels.
    votes, truth = np.zeros(len(rows)), np.zeros(len(rows))
    for i, r in enumerate(rows):
        me = own[r[0]].pop()
        votes[i], truth[i] = model.vote(*model.index.search(r[2], r[3], neighbours, me)), r[1]
    weights = np.where(truth == 1, counts[1] / n1, counts[0] / n0)
    model.slope, model.shift = _calibrate(votes, truth, weights)
    return model


_BAGS = "id string, label int, hashes array<long>, counts array<long>"


def _encode(id_col: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in ts.blocks(batch.column(text)):
                row, hashes, counts = _bags(block)
                rows = batch.slice(block.first_row, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(id_col).cast(pa.string()),
                        rows.column("__label"),
                        _lists(hashes, row, block.rows, pa.int64()),
                        _lists(counts, row, block.rows, pa.int64()),
                    ],
                    names=["id", "label", "hashes", "counts"],
                )

    return run


def _frequencies(docs: DataFrame, hashes: np.ndarray, text: str) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each word; one pass, one short table per task."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(hashes, np.ones(len(hashes))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(hashes) + 1, np.int64)
        for batch in batches:
            seen[-1] += batch.num_rows
            for block in ts.blocks(batch.column(0)):
                _, words, _ = shared.value.find(*_bags(block))
                seen[:-1] += np.bincount(words, minlength=len(hashes))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["word", "rows"])

    parts = docs.select(text).mapInArrow(run, "word long, rows long")
    totals = np.zeros(len(hashes) + 1, np.int64)
    for r in parts.groupBy("word").agg(F.sum("rows").alias("rows")).collect():
        totals[r["word"]] = r["rows"]
    return int(totals[-1]), totals[:-1]


def _known(bags: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """id, label, words, counts: the sampled documents with words of the vocabulary alone."""
    shared = bags.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            row, words, counts = shared.value.find(row, *flat)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    _lists(words, row, batch.num_rows, pa.int64()),
                    _lists(counts, row, batch.num_rows, pa.int64()),
                ],
                names=["id", "label", "words", "counts"],
            )

    return bags.mapInArrow(run, "id string, label int, words array<long>, counts array<long>")


def score(docs: DataFrame, model: Model, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with the columns score, 0 to 1, and evidence: the nearest examples of the whole text.

    Other columns pass through but for `drop`; columns called score or evidence are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in ("score", "evidence", *drop)]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("evidence", EVIDENCE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        alone = own.vote(np.zeros(0, np.int64), np.zeros(0))
        for batch in batches:
            votes, found, near = np.full(batch.num_rows, alone), [], []
            lengths = np.zeros(batch.num_rows, np.int64)
            for block in ts.blocks(batch.column(text)):
                row, words, counts = own.vocabulary.find(*_bags(block))
                cuts = np.searchsorted(row, np.arange(block.rows + 1))
                for i in np.unique(row):
                    span = slice(cuts[i], cuts[i + 1])
                    weights = own.vocabulary.weights(words[span], counts[span])
                    example, similar = own.index.search(words[span], weights, own.neighbours)
                    at = block.first_row + i
                    votes[at], lengths[at] = own.vote(example, similar), len(example)
                    found.append(example)
                    near.append(similar)
            example = np.concatenate([np.zeros(0, np.int64), *found])
            ids = pa.array(own.index.ids, pa.string()).take(pa.array(example))
            evidence = pa.StructArray.from_arrays(
                [ids, pa.array(own.index.labels[example], pa.int32()), pa.array(np.concatenate([np.zeros(0), *near]))],
                names=["doc_id", "label", "similarity"],
            )
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            columns = {f.name: batch.column(f.name) for f in kept}
            columns["score"] = pa.array(own.probability(votes))
            columns["evidence"] = pa.ListArray.from_arrays(pa.array(ends), evidence)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return docs.mapInArrow(run, schema)
