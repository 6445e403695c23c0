"""Language identification, words first, backing off to shorter and shorter character n-grams.

A model has the log frequency of words and of n-grams (inside words, with their ends marked) in
each language.  A known word scores by its own frequencies.  An unseen word scores by the mean of
its known n-grams of the greatest length of which it has any.  A document's score is the sum over
its words, and the winner's share of it is the result.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import textscan as ts
from tidelog.sources.scratch import durable

UNKNOWN = "und"
_EDGE = np.uint64(0x9AE16A3B2F90404F)


@dataclass
class Words:
    """Distinct lower-case words of a block, and where each occurs."""

    hashes: np.ndarray
    of_token: np.ndarray
    row: np.ndarray
    start: np.ndarray
    length: np.ndarray
    codes: np.ndarray


def read_words(block: ts.Block) -> Words:
    """Runs of letters; `of_token` and `row` are per occurrence, the rest per distinct word."""
    import pandas as pd

    codes = ts.lower()[block.codes]
    if not len(codes):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none, none, codes)
    letter = ts.classes()[codes] == ts.LETTER
    first = ts.row_starts(block)
    change = first.copy()
    change[1:] |= letter[1:] != letter[:-1]
    spans = np.flatnonzero(change)
    wanted = letter[spans]
    hashes = ts.hash_spans(codes, spans)[wanted]
    starts = spans[wanted]
    lengths = np.diff(np.append(spans, len(codes)))[wanted]
    of_token, distinct = pd.factorize(hashes)
    sample = np.zeros(len(distinct), np.int64)
    sample[of_token[::-1]] = np.arange(len(of_token))[::-1]
    row = np.searchsorted(block.bounds, starts, "right") - 1
    return Words(np.asarray(distinct), of_token, row, starts[sample], lengths[sample], codes)


def ngrams(words: Words, index: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the chosen words, and the place in `index` each belongs to.

    A word is taken with one edge mark before and one after it; a mark alone is no n-gram.
    """
    edge = int(n == 1)
    counts = np.maximum(words.length[index] + 2 - n + 1 - 2 * edge, 0)
    of = np.repeat(np.arange(len(index)), counts)
    at = ts.ragged(np.full(len(index), edge, np.int64), counts)
    value = np.full(len(at), np.uint64(n))
    last = max(len(words.codes) - 1, 0)
    for i in range(n):
        place = at + i
        inside = (place > 0) & (place <= words.length[index][of])
        code = words.codes[np.clip(words.start[index][of] + place - 1, 0, last)].astype(np.uint64)
        value = ts.mix(value * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, code, _EDGE))
    return value, of


def _count(text: str, lang: str, longest: int):
    """Counts of each batch: (lang, n, hash, count), n = 0 for words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        for batch in batches:
            named = batch.column(lang).dictionary_encode()
            names, of_row = named.dictionary, named.indices.to_numpy(zero_copy_only=False)
            found = []
            for block in ts.blocks(batch.column(text)):
                words = read_words(block)
                if not len(words.hashes):
                    continue
                here = of_row[block.first_row + words.row].astype(np.int64)
                pair, count = np.unique(words.of_token * len(names) + here, return_counts=True)
                word, tongue = pair // len(names), pair % len(names)
                found.append((tongue, np.zeros(len(pair), np.int64), words.hashes[word], count))
                every = np.arange(len(words.hashes))
                for n in range(1, longest + 1):
                    grams, of = ngrams(words, every, n)
                    # Pairs of one word are consecutive, as are the n-grams of one word.
                    begin = np.searchsorted(of, word, "left")
                    many = np.searchsorted(of, word, "right") - begin
                    at = ts.ragged(begin, many)
                    table = pd.DataFrame(
                        {"t": np.repeat(tongue, many), "h": grams[at], "c": np.repeat(count, many)}
                    )
                    summed = table.groupby(["t", "h"], sort=False)["c"].sum().reset_index()
                    found.append(
                        (summed["t"].to_numpy(), np.full(len(summed), n), summed["h"].to_numpy(), summed["c"].to_numpy())
                    )
            if found:
                tongue, n, grams, count = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(tongue)),
                        pa.array(n.astype(np.int32)),
                        pa.array(grams.astype(np.uint64).view(np.int64)),
                        pa.array(count.astype(np.int64)),
                    ],
                    names=["lang", "n", "hash", "count"],
                )

    return run


@dataclass
class Model:
    """Languages, and per n (0: words) sorted hashes with a row of log frequencies each.

    If the tables do not hold everything, `full` does: n, hash, logs, one row each.
    """

    languages: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]
    full: DataFrame | None = None

    def lookup(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are known, and the table rows of those."""
        keys, rows = self.tables[n]
        if not len(keys):
            return np.zeros(len(hashes), bool), np.zeros((0, len(self.languages)), np.float32)
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        known = keys[place] == hashes
        return known, rows[place[known]]

    def word_scores(self, words: Words) -> np.ndarray:
        """A row of log frequencies for each distinct word; zeros where nothing is known."""
        scores = np.zeros((len(words.hashes), len(self.languages)), np.float32)
        known, rows = self.lookup(0, words.hashes)
        scores[known] = rows
        open_words = np.flatnonzero(~known)
        for n in sorted(self.tables, reverse=True):
            if n == 0 or not len(open_words):
                continue
            grams, of = ngrams(words, open_words, n)
            found, rows = self.lookup(n, grams)
            many = np.bincount(of[found], minlength=len(open_words))
            total = np.zeros((len(open_words), len(self.languages)))
            for i in range(len(self.languages)):
                total[:, i] = np.bincount(of[found], weights=rows[:, i], minlength=len(open_words))
            some = many > 0
            scores[open_words[some]] = total[some] / many[some, None]
            open_words = open_words[~some]
        return scores


def train(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 4,
    max_cells: int = 2_000_000,
    least_count: int = 1,
) -> Model:
    """Counts over all rows of `docs` whose text and lang are not null, also of what occurs once.

    The languages are all that have a letter in some row.

    All of them take part.  Up to `max_cells` log frequencies are kept at hand; with more, these are
    the words most frequent relative to their language, and the whole table in Spark is joined.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    counts = durable(
        rows.mapInArrow(_count(text, lang, longest), "lang string, n int, hash long, count long")
        .groupBy("lang", "n", "hash")
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") >= least_count)
    )
    totals = {(r.lang, r.n): r.total for r in counts.groupBy("lang", "n").agg(F.sum("count").alias("total")).collect()}
    languages = sorted({name for name, _ in totals})
    if not languages:
        return Model([], {0: (np.zeros(0, np.uint64), np.zeros((0, 0), np.float32))})
    sizes = counts.groupBy("lang", "n").agg(F.sum("count").alias("total"))
    share = F.max(F.col("count") / F.col("total"))
    columns = [F.sum(F.when(F.col("lang") == name, F.col("count"))).alias(f"c{i}") for i, name in enumerate(languages)]
    table = durable(
        counts.join(F.broadcast(sizes), ["lang", "n"])  # one row per language and length
        .groupBy("n", "hash")
        .agg(share.alias("share"), *columns)
    )
    entries = {r.n: r["count"] for r in table.groupBy("n").count().collect()}
    most = max(1, max_cells // len(languages))
    complete = sum(entries.values()) <= most
    # Joined, only words are looked up at hand.
    first = table.where("n = 0").orderBy(F.desc("share"), "hash").limit(most)
    kept = (table if complete else first).drop("share").toArrow()
    length = kept.column("n").to_numpy()
    keys = kept.column("hash").to_numpy().view(np.uint64)
    found = np.stack(
        [kept.column(f"c{i}").fill_null(0).to_numpy().astype(np.float64) for i in range(len(languages))], axis=1
    )
    tables, below = {}, {}
    for n in range(longest + 1):
        mine = length == n
        order = np.argsort(keys[mine])
        total = np.array([totals.get((name, n), 0) for name in languages], np.float64)
        below[n] = total + 0.5 * max(1, entries.get(n, 0))
        smooth = np.log((found[mine][order] + 0.5) / below[n][None])
        tables[n] = (keys[mine][order], smooth.astype(np.float32))
    if complete:
        return Model(languages, tables)
    logs = []
    for i in range(len(languages)):
        by_length = F.create_map(*[F.lit(x) for n in below for x in (n, float(below[n][i]))])
        some = F.coalesce(F.col(f"c{i}"), F.lit(0)) + 0.5
        logs.append(F.log(some / by_length[F.col("n")]).cast("float"))
    return Model(languages, tables, table.select("n", "hash", F.array(*logs).alias("logs")))


def _open_words(known: Model, text: str, kept: list[str]):
    """Each batch's rows with the sums of words at hand, and the others: hash, count and letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for batch in batches:
            total = np.zeros((batch.num_rows, len(model.languages)))
            has = np.zeros(batch.num_rows, bool)
            many, hashes, counts, letters = np.zeros(batch.num_rows, np.int64), [], [], []
            for block in ts.blocks(batch.column(text)):
                words = read_words(block)
                if not len(words.hashes):
                    continue
                rows = slice(block.first_row, block.first_row + block.rows)
                has[rows] = np.bincount(words.row, minlength=block.rows) > 0
                at_hand, logs = model.lookup(0, words.hashes)
                place = np.cumsum(at_hand) - 1
                here = at_hand[words.of_token]
                for i in range(len(model.languages)):
                    weights = logs[place[words.of_token[here]], i].astype(np.float64)
                    total[rows, i] = np.bincount(words.row[here], weights=weights, minlength=block.rows)
                # Rows first, so that the open words of one row lie together.
                pair, count = np.unique(
                    words.row[~here] * len(words.hashes) + words.of_token[~here], return_counts=True
                )
                row, word = pair // len(words.hashes), pair % len(words.hashes)
                many[rows] = np.bincount(row, minlength=block.rows)
                hashes.append(words.hashes[word].view(np.int64))
                counts.append(count)
                letters += ts.strings(words.codes, words.start[word], words.start[word] + words.length[word])
            ends = pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32))
            none = [np.zeros(0, np.int64)]
            columns = {name: batch.column(name) for name in kept}
            columns["__has"] = pa.array(has)
            columns["__sums"] = pa.FixedSizeListArray.from_arrays(
                pa.array(total.ravel()), len(model.languages)
            ).cast(pa.list_(pa.float64()))
            columns["__hash"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(hashes or none)))
            columns["__count"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts or none)))
            columns["__word"] = pa.ListArray.from_arrays(ends, pa.array(letters, pa.string()))
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return run


def _word_ngrams(n: int):
    """(word, hash) of the n-grams of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.column("hash").to_numpy()
            for block in ts.blocks(batch.column("word")):
                own = name[block.first_row : block.first_row + block.rows]
                none = np.zeros(0, np.int64)
                words = Words(own, none, none, block.bounds[:-1], np.diff(block.bounds), block.codes)
                grams, of = ngrams(words, np.arange(block.rows), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[of]), pa.array(grams.view(np.int64))], names=["word", "hash"]
                )

    return run


def _predict_joined(
    docs: DataFrame, model: Model, text: str, kept: list[T.StructField], salts: int = 4
) -> DataFrame:
    """As predict, with words that are not at hand, and n-grams of unseen ones, joined to the whole table.

    Frequent keys are spread over `salts`.
    """
    size = len(model.languages)
    shared = docs.sparkSession.sparkContext.broadcast(Model(model.languages, model.tables))
    own = T.StructType(
        [
            *kept,
            T.StructField("__row", T.LongType()),
            T.StructField("__has", T.BooleanType()),
            T.StructField("__sums", T.ArrayType(T.DoubleType())),
            T.StructField("__hash", T.ArrayType(T.LongType())),
            T.StructField("__count", T.ArrayType(T.LongType())),
            T.StructField("__word", T.ArrayType(T.StringType())),
        ]
    )
    names = [f.name for f in kept]
    parts = durable(
        docs.withColumn("__row", F.monotonically_increasing_id()).mapInArrow(
            _open_words(shared, text, [*names, "__row"]), own
        )
    )
    zipped = F.explode(F.arrays_zip("__hash", "__count", "__word")).alias("w")
    open_words = parts.select("__row", zipped).select(
        "__row", F.col("w.__hash").alias("hash"), F.col("w.__count").alias("count"), F.col("w.__word").alias("word")
    )
    distinct = open_words.groupBy("hash").agg(F.min("word").alias("word"))
    looked_up = durable(distinct.join(model.full.where("n = 0").select("hash", "logs"), "hash", "left"))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    scored = looked_up.where("logs IS NOT NULL").select("hash", "logs")
    unseen = looked_up.where("logs IS NULL").select("hash", "word")
    for n in sorted((n for n in model.tables if n > 0), reverse=True):
        grams = unseen.mapInArrow(_word_ngrams(n), "word long, hash long").withColumn(
            "salt", F.pmod(F.col("word"), F.lit(salts)).cast("int")
        )
        means = [F.avg(F.col("logs")[i].cast("double")).cast("float") for i in range(size)]
        found = durable(
            grams.join(model.full.where(F.col("n") == n).select("hash", "logs", every_salt), ["hash", "salt"])
            .groupBy(F.col("word").alias("hash"))
            .agg(F.array(*means).alias("logs"))
        )
        scored = scored.union(found)
        unseen = unseen.join(found.select("hash"), "hash", "left_anti")
    scored = scored.select("*", every_salt)
    sums = (
        open_words.withColumn("salt", F.pmod(F.xxhash64("__row"), F.lit(salts)).cast("int"))
        .join(scored, ["hash", "salt"])
        .groupBy("__row")
        .agg(F.array(*[F.sum(F.col("logs")[i].cast("double") * F.col("count")) for i in range(size)]).alias("__more"))
    )
    total = F.when(F.col("__more").isNull(), F.col("__sums")).otherwise(
        F.zip_with("__sums", "__more", lambda a, b: a + b)
    )
    best = F.array_max("__total")
    odds = F.aggregate("__total", F.lit(0.0), lambda acc, x: acc + F.exp(x - best))
    languages = F.array(*[F.lit(name) for name in model.languages])
    pred = F.element_at(languages, F.array_position("__total", best).cast("int"))
    return (
        parts.drop("__hash", "__count", "__word")
        .join(sums, "__row", "left")
        .withColumn("__total", total)
        .select(
            *[F.col(f"`{name}`") for name in names],
            F.when(F.col("__has"), pred).otherwise(UNKNOWN).alias("lang_pred"),
            F.when(F.col("__has"), 1 / odds).otherwise(0.0).alias("score"),
        )
    )


def predict(docs: DataFrame, model: Model, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with lang_pred and score; other columns pass through but for `drop`.

    A text that is null or has no letter is `und` with score 0, as is every text where the model
    knows no language.  A tie goes to the language that comes first by name.  Columns that are
    called lang_pred or score are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", *drop)]
    if model.full is not None:
        return _predict_joined(docs, model, text, kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNKNOWN], object)
        for batch in batches:
            best = np.full(batch.num_rows, len(known.languages))
            score = np.zeros(batch.num_rows)
            for block in ts.blocks(batch.column(text)) if known.languages else ():
                words = read_words(block)
                if not len(words.hashes):
                    continue
                per_word = known.word_scores(words).astype(np.float64)
                total = np.stack(
                    [
                        np.bincount(words.row, weights=per_word[words.of_token, i], minlength=block.rows)
                        for i in range(len(known.languages))
                    ],
                    axis=1,
                )
                has = np.bincount(words.row, minlength=block.rows) > 0
                top = total.argmax(axis=1)
                odds = np.exp(total - total.max(axis=1, keepdims=True))
                rows = slice(block.first_row, block.first_row + block.rows)
                best[rows] = np.where(has, top, len(known.languages))
                score[rows] = np.where(has, 1 / odds.sum(axis=1), 0.0)
            columns = {f.name: batch.column(f.name) for f in kept}
            columns["lang_pred"] = pa.array(names[best], pa.string())
            columns["score"] = pa.array(score)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    schema = T.StructType(
        [*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return docs.mapInArrow(run, schema)
