"""Byte-level BPE, encoded and decoded by DuckDB inside each partition.

Texts are cut into pretokens; the distinct ones that a worker has not met are rows of
(word, position, token) in DuckDB.  A recursive query joins each neighbouring pair to the merge
table and contracts the leftmost pair of least rank of every word, until no word has a pair.
Decoding joins ids to their bytes and puts them together by an ordered aggregate.
"""

import base64
from collections.abc import Iterator
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidelog.llm import textscan as ts

#: One step of every word: pairs are linked rows (token, its right neighbour), so that a step is
#: hash joins only.  A key is rank and position, its minimum the leftmost pair of least rank.
_ENCODE = """
WITH RECURSIVE t(w, pos, tok, nxt, ntok, live) AS (
    SELECT w, pos, tok, nxt, ntok, true FROM pieces
    UNION ALL
    SELECT r.w, r.pos,
           CASE WHEN r.pos = b.spot THEN b.merged ELSE r.tok END,
           CASE WHEN r.pos = b.spot THEN b.nxt ELSE r.nxt END,
           CASE WHEN r.pos = b.spot THEN b.ntok WHEN r.nxt = b.spot THEN b.merged ELSE r.ntok END,
           b.spot IS NOT NULL
    FROM t r LEFT JOIN (
        SELECT m.w, m.k & 16777215 AS spot, m.k >> 24 AS merged, m.gone, g.nxt, g.ntok
        FROM (
            SELECT t.w, min((p.rank::BIGINT << 24) | t.pos) AS k,
                   arg_min(t.nxt, (p.rank::BIGINT << 24) | t.pos) AS gone
            FROM t JOIN merges p ON p.pair = (t.tok::BIGINT << 32) | t.ntok
            WHERE t.live GROUP BY t.w
        ) m JOIN t g ON g.w = m.w AND g.pos = m.gone AND g.live
    ) b USING (w)
    WHERE r.live AND (b.spot IS NULL OR r.pos <> b.gone)
)
SELECT w, pos, tok FROM t WHERE NOT live ORDER BY w, pos
"""
#: The same step, kept in a table between steps, for long words: a recursive query would hold
#: every earlier state.
_LONG_STEP = """
CREATE OR REPLACE TEMP TABLE long_next AS
SELECT r.w, r.pos,
       CASE WHEN r.pos = b.spot THEN b.merged ELSE r.tok END AS tok,
       CASE WHEN r.pos = b.spot THEN b.nxt ELSE r.nxt END AS nxt,
       CASE WHEN r.pos = b.spot THEN b.ntok WHEN r.nxt = b.spot THEN b.merged ELSE r.ntok END AS ntok
FROM long_rows r JOIN (
    SELECT m.w, m.spot, m.merged, m.gone, g.nxt, g.ntok
    FROM long_best m JOIN long_rows g ON g.w = m.w AND g.pos = m.gone
) b ON r.w = b.w
"""


class Codec:
    """The merge table of one rank file in an in-process DuckDB."""

    def __init__(self, path: str, long_word: int = 256):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.long_word = long_word
        pairs = [
            (ranks[word[:i]], ranks[word[i:]], rank)
            for word, rank in ranks.items()
            for i in range(1, len(word))
            if word[:i] in ranks and word[i:] in ranks
        ]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._load("merges", {"pair": (left << 32) | right, "rank": rank})
        self._load(
            "vocabulary",
            {
                "id": np.array(list(ranks.values()), np.int32),
                "piece": [word.decode("latin-1") for word in ranks],  # one character per byte
            },
        )
        self.whole = ranks  # a pretoken that is a token needs no merging
        self.words = ts.TokenCache(self.encode_words)

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("loaded", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM loaded")
        self.db.unregister("loaded")

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has."""
        data = [w.encode("utf-8") for w in words]
        whole = np.array([self.whole.get(b, -1) for b in data], np.int64)
        sizes = np.array([len(b) for b in data], np.int64)
        found_w = [np.flatnonzero(whole >= 0)]
        found_id = [whole[found_w[0]]]
        for long in (False, True):
            index = np.flatnonzero((whole < 0) & ((sizes > self.long_word) == long))
            if len(index):
                w, ids = self._contract([data[i] for i in index], long)
                found_w.append(index[w])
                found_id.append(ids)
        w, ids = np.concatenate(found_w), np.concatenate(found_id)
        order = np.argsort(w, kind="stable")
        lengths = np.bincount(w, minlength=len(words)).astype(np.int64)
        return ids[order].astype(np.int32), lengths

    def _pieces(self, data: list[bytes]) -> dict:
        sizes = np.array([len(b) for b in data], np.int64)
        tokens = self.byte_ids[np.frombuffer(b"".join(data), np.uint8)]
        position = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        last = position == np.repeat(sizes, sizes) - 1
        return {
            "w": np.repeat(np.arange(len(data), dtype=np.int32), sizes),
            "pos": position.astype(np.int32),
            "tok": tokens,
            "nxt": np.where(last, -1, position + 1).astype(np.int32),
            "ntok": np.where(last, -1, np.append(tokens[1:], -1)).astype(np.int32),
        }

    def _contract(self, data: list[bytes], long: bool) -> tuple[np.ndarray, np.ndarray]:
        out_w, out_id, step = [], [], 1 if long else 20_000
        for lo in range(0, len(data), step):
            table = self._pieces(data[lo : lo + step])
            if long:
                self._load("long_rows", table)
                rows = self._long()
            else:
                self._load("pieces", table)
                rows = self.db.sql(_ENCODE).to_arrow_table()
            out_w.append(rows.column("w").to_numpy() + lo)
            out_id.append(rows.column("tok").to_numpy())
        return np.concatenate(out_w), np.concatenate(out_id)

    def _long(self) -> pa.Table:
        while True:
            self.db.execute(
                """CREATE OR REPLACE TEMP TABLE long_best AS
                SELECT w, k & 1099511627775 AS spot, (k >> 40)::INT AS merged, gone FROM (
                    SELECT t.w, min((p.rank::BIGINT << 40) | t.pos) AS k,
                           arg_min(t.nxt, (p.rank::BIGINT << 40) | t.pos) AS gone
                    FROM long_rows t JOIN merges p ON p.pair = (t.tok::BIGINT << 32) | t.ntok
                    GROUP BY t.w)"""
            )
            if not self.db.execute("SELECT count(*) FROM long_best").fetchall()[0][0]:
                return self.db.sql("SELECT w, pos, tok FROM long_rows ORDER BY w, pos").to_arrow_table()
            self.db.execute(_LONG_STEP + "WHERE r.pos <> b.gone")
            self.db.execute("CREATE OR REPLACE TABLE long_rows AS SELECT * FROM long_next")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and how many each row has."""
        all_ids, all_counts = [], []
        for block in ts.blocks(texts):
            starts = ts.spaced_tokens(block)
            ids, counts = ts.encode_tokens(self.words, block.codes, starts, None)
            all_ids.append(ids)
            all_counts.append(ts.per_row(counts, starts, block.bounds))
        none = [np.zeros(0, np.int64)]
        return np.concatenate(all_ids or none), np.concatenate(all_counts or none)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each row's ids; an id that is no token raises."""
        out, first = [], 0
        bounds = np.concatenate([[0], np.cumsum(counts)])
        while first < len(counts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + 500_000, "right")) - 1)
            lo, hi = bounds[first], bounds[last]
            rows = np.repeat(np.arange(last - first), counts[first:last])
            self._load("ids", {"r": rows, "pos": np.arange(lo, hi), "id": ids[lo:hi].astype(np.int32)})
            decoded = self.db.sql(
                """SELECT r, count(*) AS n, string_agg(piece, '' ORDER BY pos) AS data
                FROM ids JOIN vocabulary USING (id) GROUP BY r"""
            ).to_arrow_table()
            if decoded.num_rows and sum(decoded.column("n").to_pylist()) != hi - lo or not decoded.num_rows and hi > lo:
                raise ValueError("an id is not in the vocabulary")
            block: list = [b""] * (last - first)
            for r, data in zip(decoded.column("r").to_pylist(), decoded.column("data").to_pylist(), strict=True):
                block[r] = data.encode("latin-1")
            out += block
            first = last
        return pa.array(out, pa.binary())


@cache
def codec(path: str) -> Codec:
    """One codec for each rank file and Python worker."""
    return Codec(path)


def _add(batch: pa.RecordBatch, new: dict, drop: tuple) -> pa.RecordBatch:
    kept = {n: batch.column(n) for n in batch.schema.names if n not in new and n not in drop}
    return pa.RecordBatch.from_arrays([*kept.values(), *new.values()], names=[*kept, *new])


def _schema(df: DataFrame, new: dict, drop: tuple) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in new and f.name not in drop]
    return T.StructType([*kept, *(T.StructField(n, t) for n, t in new.items())])


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def encode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", drop: tuple[str, ...] = ()
) -> DataFrame:
    """`df` with the token ids of `text`, as an array of ints in the column `ids`.

    `path` is a rank file (base64 token, rank) that every executor can open.  Null and empty
    texts have no ids.  Other columns pass through but for those in `drop`; a column that is
    already called `ids` is replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _add(batch, {ids: _lists(*codec(path).encode(batch.column(text)))}, drop)

    return df.mapInArrow(run, _schema(df, {ids: T.ArrayType(T.IntegerType())}, drop))


def decode(
    df: DataFrame, path: str, ids: str = "ids", data: str = "decoded", drop: tuple[str, ...] = ()
) -> DataFrame:
    """`df` with the bytes that `ids` stand for in the column `data`; null ids are no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids)
            counts = pc.fill_null(lists.value_lengths(), 0).to_numpy().astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            yield _add(batch, {data: codec(path).decode(values, counts)}, drop)

    return df.mapInArrow(run, _schema(df, {data: T.BinaryType()}, drop))


def round_trip(
    df: DataFrame,
    path: str,
    text: str = "text",
    ids: str = "ids",
    data: str = "decoded",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """encode, then decode of those ids, in one pass: the ids do not travel in between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = codec(path).encode(batch.column(text))
            new = {ids: _lists(values, counts), data: codec(path).decode(values, counts)}
            yield _add(batch, new, drop)

    return df.mapInArrow(
        run, _schema(df, {ids: T.ArrayType(T.IntegerType()), data: T.BinaryType()}, drop)
    )
