"""Document quality by multiple-instance learning with gated attention.

A document is a bag of passages.  Every passage is encoded from its shape (characters by class,
word lengths, repetition) and a hashed bag of its words; attention with a gate weighs the
passages; the weighted mean of their encodings is scored.  Only documents have labels: what to
attend to is learned from them.
"""

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import textscan as ts

_SIGNS = {ord(c): i for i, c in enumerate(string.punctuation)}
_LOWER, _UPPER, _DIGIT, _BLANK, _BREAK, _REST, _CLASSES = 32, 33, 34, 35, 36, 37, 38
_WORD_BINS = 128
#: Classes of characters, five figures on words, hashed words.
WIDTH = _CLASSES + 5 + _WORD_BINS
PASSAGE_WORDS = 64


def _class_table() -> np.ndarray:
    kind = ts.classes()
    table = np.full(0x110000, _REST, np.int32)
    table[kind == ts.LETTER] = _LOWER
    table[(kind == ts.LETTER) & (ts.lower() != np.arange(0x110000))] = _UPPER
    table[kind == ts.NUMBER] = _DIGIT
    table[kind == ts.SPACE] = _BLANK
    table[0x0A] = _BREAK
    table[list(_SIGNS)] = list(_SIGNS.values())
    return table


_TABLES: dict[str, np.ndarray] = {}


def passages(block: ts.Block, words_each: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a block, and the number of passages of each row.

    A passage is `words_each` words, the last one of a row what is left; a row without words is
    one passage of zeros.
    """
    if "class" not in _TABLES:
        _TABLES["class"] = _class_table()
    codes = block.codes
    if not len(codes):
        return np.zeros((block.rows, WIDTH), np.float32), np.ones(block.rows, np.int64)
    blank = ts.classes()[codes] == ts.SPACE
    first = ts.row_starts(block)
    change = first.copy()
    change[1:] |= blank[1:] != blank[:-1]
    spans = np.flatnonzero(change)
    is_word = ~blank[spans]
    starts = spans[is_word]
    lengths = np.diff(np.append(spans, len(codes)))[is_word]
    row = np.searchsorted(block.bounds, starts, "right") - 1
    per_row = np.bincount(row, minlength=block.rows)
    many = np.maximum(-(-per_row // words_each), 1)
    before = np.cumsum(many) - many
    in_row = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    passage = before[row] + in_row // words_each
    n = int(many.sum())
    # Every character belongs to the passage of the last word that began at or before it.
    owner = np.repeat(before, np.diff(block.bounds))
    if len(starts):
        last = np.cumsum(np.bincount(starts, minlength=len(codes))) - 1
        same = (last >= 0) & (row[np.maximum(last, 0)] == np.repeat(np.arange(block.rows), np.diff(block.bounds)))
        owner = np.where(same, passage[np.maximum(last, 0)], owner)
    chars = np.bincount(owner * _CLASSES + _TABLES["class"][codes], minlength=n * _CLASSES).reshape(n, _CLASSES)
    out = np.zeros((n, WIDTH), np.float32)
    out[:, :_CLASSES] = np.sqrt(chars / np.maximum(chars.sum(axis=1, keepdims=True), 1))
    words = np.bincount(passage, minlength=n)
    some = np.maximum(words, 1)
    hashes = ts.hash_spans(ts.lower()[codes], spans)[is_word]
    repeat = np.zeros(len(hashes), bool)
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((hashes, passage))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    mean = np.bincount(passage, weights=lengths, minlength=n) / some
    square = np.bincount(passage, weights=lengths.astype(float) ** 2, minlength=n) / some
    out[:, _CLASSES + 0] = mean / 10
    out[:, _CLASSES + 1] = np.sqrt(np.maximum(square - mean**2, 0)) / 10
    out[:, _CLASSES + 2] = np.bincount(passage[repeat], minlength=n) / some
    out[:, _CLASSES + 3] = np.bincount(passage[order][new], minlength=n) / some
    out[:, _CLASSES + 4] = np.log1p(words) / 5
    bins = np.bincount(
        passage * _WORD_BINS + (hashes % np.uint64(_WORD_BINS)).astype(np.int64), minlength=n * _WORD_BINS
    ).reshape(n, _WORD_BINS)
    out[:, _CLASSES + 5 :] = np.sqrt(bins / some[:, None])
    return out, many


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights by name, and the figures that centre and scale the features."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    constant: float | None = None

    def forward(self, features: np.ndarray, many: np.ndarray) -> dict[str, np.ndarray]:
        """All intermediate values; `many` is the number of passages of each document."""
        w = self.weights
        x = (features - self.mean) / self.scale
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        view, gate = np.tanh(h @ w["view"]), _sigmoid(h @ w["gate"])
        raw = (view * gate) @ w["attend"]
        starts = np.cumsum(many) - many
        top = np.repeat(np.maximum.reduceat(raw, starts), many)
        power = np.exp(raw - top)
        weight = power / np.repeat(np.add.reduceat(power, starts), many)
        pooled = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        logit = pooled @ w["out"] + w["out_bias"]
        return {"x": x, "h": h, "view": view, "gate": gate, "weight": weight, "pooled": pooled, "logit": logit}

    def score(self, features: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each document and attention weight of each passage."""
        if self.constant is not None:
            return np.full(len(many), self.constant), 1 / np.repeat(many, many)
        seen = self.forward(features, many)
        return _sigmoid(seen["logit"]), seen["weight"]

    def gradient(self, features, many, label, weight_of) -> dict[str, np.ndarray]:
        """Gradient of the weighted mean log loss."""
        w, s = self.weights, self.forward(features, many)
        d_logit = (_sigmoid(s["logit"]) - label) * weight_of / weight_of.sum()
        d_pooled = d_logit[:, None] * w["out"]
        of = np.repeat(np.arange(len(many)), many)
        per = (d_pooled[of] * s["h"]).sum(axis=1)
        d_raw = s["weight"] * (per - np.repeat(np.add.reduceat(s["weight"] * per, np.cumsum(many) - many), many))
        both = d_raw[:, None] * w["attend"]
        d_view = both * s["gate"] * (1 - s["view"] ** 2)
        d_gate = both * s["view"] * s["gate"] * (1 - s["gate"])
        d_h = s["weight"][:, None] * d_pooled[of] + d_view @ w["view"].T + d_gate @ w["gate"].T
        d_pre = d_h * (1 - s["h"] ** 2)
        return {
            "out": s["pooled"].T @ d_logit,
            "out_bias": d_logit.sum(),
            "attend": (s["view"] * s["gate"]).T @ d_raw,
            "view": s["h"].T @ d_view,
            "gate": s["h"].T @ d_gate,
            "encode": s["x"].T @ d_pre,
            "encode_bias": d_pre.sum(axis=0),
        }


def _spread(features: np.ndarray, rows: int = 65_536) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale of each feature, some rows at a time: features stay in half precision."""
    total, square = np.zeros(features.shape[1]), np.zeros(features.shape[1])
    for lo in range(0, len(features), rows):
        part = features[lo : lo + rows].astype(np.float64)
        total += part.sum(axis=0)
        square += (part * part).sum(axis=0)
    mean = total / len(features)
    return mean, np.sqrt(np.maximum(square / len(features) - mean * mean, 0)) + 0.05


def fit(
    features: np.ndarray,
    many: np.ndarray,
    label: np.ndarray,
    weight_of: np.ndarray,
    hidden: int = 24,
    attention: int = 12,
    epochs: int = 30,
    batch: int = 128,
    decay: float = 1e-4,
    seed: int = 7,
) -> Model:
    """Adam on the log loss of documents; the same input gives the same model."""
    rng = np.random.default_rng(seed)
    spread = lambda a, b: rng.standard_normal((a, b)) / np.sqrt(a)
    weights = {
        "encode": spread(WIDTH, hidden),
        "encode_bias": np.zeros(hidden),
        "view": spread(hidden, attention),
        "gate": spread(hidden, attention),
        "attend": spread(attention, 1)[:, 0],
        "out": spread(hidden, 1)[:, 0],
        "out_bias": np.zeros(()),
    }
    model = Model(weights, *_spread(features))
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    starts, step = np.cumsum(many) - many, 0
    for _ in range(epochs):
        order = rng.permutation(len(many))
        for lo in range(0, len(order), batch):
            docs = order[lo : lo + batch]
            rows = ts.ragged(starts[docs], many[docs])
            slope = model.gradient(features[rows].astype(np.float32), many[docs], label[docs], weight_of[docs])
            step += 1
            for k, g in slope.items():
                g = g + decay * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[k] = weights[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text: str = "text",
    sample_rows: int = 2000,
    seed: int = 7,
) -> Model:
    """Learn from at most `sample_rows` labelled documents of each class.

    They are those with the smallest hash of their id, weighted so that the classes count as they
    do among all labels; all passages of their whole texts take part.  The bound is fixed, whatever
    the corpus.  Rows without id or label are left out; of
    labels that repeat an id the greatest counts.  If a class has no documents the model is the
    constant share of label 1, and without labels 0.5.
    """
    marked = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .groupBy(id_col)
        .agg(F.max(label).cast("int").alias("__label"))
    )
    marked = marked.where(F.col("__label").isin(0, 1))
    counts = {r["__label"]: r["count"] for r in marked.groupBy("__label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Model({}, np.zeros(WIDTH), np.ones(WIDTH), 0.5 if not total else counts.get(1, 0) / total)
    order = [F.xxhash64(F.col(id_col), F.lit(seed)), F.col(id_col)]
    chosen = None
    for value in (0, 1):
        few = marked.where(F.col("__label") == value).orderBy(*order).limit(sample_rows)
        chosen = few if chosen is None else chosen.union(few)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.each(batches):
            for block in ts.blocks(batch.column(text)):
                features, many = passages(block)
                starts = np.cumsum(many) - many
                out = []
                for i in range(block.rows):
                    out.append(features[starts[i] : starts[i] + many[i]].astype(np.float16).tobytes())
                rows = batch.slice(block.first_row, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(id_col), rows.column("__label"), pa.array(out, pa.binary())],
                    names=[id_col, "__label", "features"],
                )

    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("__label", T.IntegerType()),
            T.StructField("features", T.BinaryType()),
        ]
    )
    # At most 2 * sample_rows ids.
    sample = (
        docs.select(id_col, text).join(F.broadcast(chosen), id_col).mapInArrow(encode, schema).toArrow()
    ).sort_by(id_col)
    if not sample.num_rows:
        return Model({}, np.zeros(WIDTH), np.ones(WIDTH), counts.get(1, 0) / total)
    bags = [np.frombuffer(x, np.float16).reshape(-1, WIDTH) for x in sample.column("features").to_pylist()]
    many = np.array([len(b) for b in bags])
    truth = sample.column("__label").to_numpy().astype(np.float64)
    have = {v: max(1, int((truth == v).sum())) for v in (0, 1)}
    weight_of = np.where(truth == 1, counts[1] / have[1], counts[0] / have[0]) / total
    return fit(np.concatenate(bags), many, truth, weight_of, seed=seed)


def score(docs: DataFrame, model: Model, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with the column score, 0 to 1, from all passages of the whole text.

    Null, empty and wordless texts are one passage without words and have a score, too.  Other
    columns pass through but for `drop`; a column that is called score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in ("score", *drop)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.each(batches):
            result = np.zeros(batch.num_rows)
            for block in ts.blocks(batch.column(text)):
                features, many = passages(block)
                result[block.first_row : block.first_row + block.rows] = shared.value.score(features, many)[0]
            columns = {f.name: batch.column(f.name) for f in kept}
            columns["score"] = pa.array(result)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))
