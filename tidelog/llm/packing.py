"""Best-fit packing of tokenised documents, certified by lower bounds and repaired by exchange.

Pieces are dealt out to partitions.  Each packs its own by best-fit decreasing over lengths and
proves by dual feasible functions how few sequences could hold them.  Partitions above their
bound give up their loose sequences; what they held meets in fewer partitions and is packed
again, round after round, until every partition is certified or nothing improves.

Only lengths take part: a partition is at most a histogram of `capacity` counts.
"""

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from tidelog.llm import textscan as ts
from tidelog.sources.scratch import durable


@cache
def _byte_alphabet() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of a word-level BPE file, each distinct word encoded once per worker.

    With `added` the strings of the file's added tokens stand for their ids, as by default in
    the library; without, they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder() if added else {}
        self.added = {token.content: number for number, token in tokens.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        # Tokens that are looked for in another way are left to the library.
        self.by_library = any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in tokens.values())
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        # Words arrive cut and normalised, so the bare model over blanks will do.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.words = ts.TokenCache(self._encode_words)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words in groups, a blank between them: the token that ends a word tells them apart."""
        data = [w.encode("utf-8").decode("latin-1").translate(_byte_alphabet()) for w in words]
        groups = [" ".join(data[i : i + 256]) for i in range(0, len(data), 256)]
        found = self.model.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.concatenate([np.array(f.ids, np.int64) for f in found])
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and how many each row has."""
        if self.by_library:
            found = [self.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
            return np.array([*itertools.chain(*found)], np.int64), np.array([*map(len, found)], np.int64)
        hit = np.zeros(len(texts), bool)
        for token in self.added:
            hit |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        if not hit.any():
            return self._encode(texts)
        ids, counts = self._encode(pc.if_else(pa.array(hit), None, texts))
        # Text and added tokens in turn, a text first and last.
        rows = [self.cut.split(t) for t in texts.filter(pa.array(hit)).to_pylist()]
        own, many = self._encode(pa.array([t for row in rows for t in row[::2]], pa.large_string()))
        token = np.array([self.added.get(t, -1) for row in rows for t in (*row[1::2], "")])
        own = np.insert(own, np.cumsum(many)[token >= 0], token[token >= 0])
        texts_of = [len(row) // 2 + 1 for row in rows]
        sizes = np.add.reduceat(many + (token >= 0), np.cumsum([0, *texts_of[:-1]]))
        ids = np.insert(ids, np.repeat((np.cumsum(counts) - counts)[hit], sizes), own)
        counts[hit] = sizes
        return ids, counts

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        all_ids, all_counts = [], []
        for block in ts.blocks(texts):
            block = self._normalised(block)
            starts, wanted = ts.bare_tokens(block.codes, ts.row_starts(block))
            ids, counts = ts.encode_tokens(self.words, block.codes, starts, wanted)
            all_ids.append(ids)
            all_counts.append(ts.per_row(counts, starts, block.bounds))
        none = [np.zeros(0, np.int64)]
        return np.concatenate(all_ids or none), np.concatenate(all_counts or none)

    def _normalised(self, block: ts.Block) -> ts.Block:
        """Composed, lower-case texts.

        Below U+0300 every text is composed already, so a table does; rows with other
        characters go through the tokenizer's own normaliser.
        """
        odd = (block.codes >= 0x300) | (block.codes == 0x130)
        if not odd.any():
            return ts.Block(block.first_row, ts.lower()[block.codes], block.bounds)
        hit = np.unique(np.searchsorted(block.bounds, np.flatnonzero(odd), "right") - 1)
        parts, at = [], 0
        lengths = np.diff(block.bounds)
        for row in hit.tolist():
            lo, hi = block.bounds[row], block.bounds[row + 1]
            parts.append(ts.lower()[block.codes[at:lo]])
            text = block.codes[lo:hi].tobytes().decode("utf-32-le")
            done = self.tokenizer.normalizer.normalize_str(text)
            parts.append(np.frombuffer(done.encode("utf-32-le"), np.uint32))
            lengths[row] = len(parts[-1])
            at = hi
        parts.append(ts.lower()[block.codes[at:]])
        return ts.Block(block.first_row, np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)]))


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each file and Python worker."""
    return WordTokenizer(path, added=True)


def cut_documents(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids: each document's tokens, `end_id` last.

    Only documents of more than `capacity` ids are cut; null and empty texts have the end id
    alone.  The file's added tokens are read in a text as the library does.  ids_crc32 is over the ids as little-endian 32-bit numbers.  Rows that repeat an id,
    or have none, are documents of their own.  `with_ids=False` leaves the ids out.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.each(batches):
            ids, counts = word_tokenizer(path).encode(batch.column(text))
            sizes = counts + 1
            ends = np.cumsum(sizes)
            full = np.full(int(sizes.sum()), end_id, np.int32)
            keep = np.ones(len(full), bool)
            keep[ends - 1] = False
            full[keep] = ids
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            length = np.minimum(sizes[row] - start, capacity)
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            raw, cuts = full.astype("<u4").tobytes(), (4 * offsets).tolist()
            sums = [zlib.crc32(raw[x:y]) for x, y in itertools.pairwise(cuts)]
            columns = {
                id_col: batch.column(id_col).take(pa.array(row)),
                "piece": pa.array(number.astype(np.int32)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(full))
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    fields = [
        T.StructField(id_col, kind),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ][: 6 if with_ids else 5]
    return docs.select(id_col, text).mapInArrow(run, T.StructType(fields))


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing of these pieces (counts by length) takes fewer sequences.

    Dual feasible functions: f_k for every threshold k turns pieces over capacity - k into
    whole sequences and drops those under k; u_n rounds lengths to n-ths.  Each keeps sums of
    at most `capacity` at or below one, so the total is a bound.
    """
    length = np.arange(len(counts))
    best = -(-int((counts * length).sum()) // capacity)
    sums = np.concatenate([[0], np.cumsum(counts * length)])
    many = np.concatenate([[0], np.cumsum(counts)])
    for k in range(1, capacity // 2 + 1):
        whole = int(many[capacity + 1] - many[capacity - k + 1])
        between = int(sums[capacity - k + 1] - sums[k])
        best = max(best, whole + -(-between // capacity))
    for n in range(1, 33):
        scaled = (n + 1) * length
        exact = scaled % capacity == 0
        # In units of 1 / (n * capacity): x if (n+1)x is whole, else floor((n+1)x) / n.
        value = np.where(exact, length * n, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (n * capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best-fit decreasing on lengths: (how many sequences, ((length, pieces in each), ...)).

    Equal sequences are kept once with their number, so the work follows the number of
    different lengths and fillings, not the number of pieces.
    """
    # Open sequences by room left: {room: {contents: number}}.
    open_bins: dict[int, dict[tuple, int]] = {}
    rooms: list[int] = []

    def put(room: int, contents: tuple, number: int) -> None:
        if room not in open_bins:
            open_bins[room] = {}
            bisect.insort(rooms, room)
        open_bins[room][contents] = open_bins[room].get(contents, 0) + number

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                each = min(capacity // length, left)
                number = left // each
                put(capacity - each * length, ((length, each),), number)
                left -= each * number
                continue
            room = rooms[i]
            contents, number = open_bins[room].popitem()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(i)
            # Best fit goes on filling the same sequence while it stays the tightest.
            each = min(room // length, left)
            used = min(number, left // each)
            put(room - each * length, (*contents, (length, each)), used)
            if used < number:
                put(room, contents, number - used)
            left -= each * used
    return [(n, c) for held in open_bins.values() for c, n in held.items()]


def fill_sums(counts: np.ndarray, capacity: int, seed: int = 0) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Sequences one by one: the longest piece left, and of all others those that fill it best.

    What sums can be reached is a set of bits, exact for each sequence; the seed (0: longest first)
    sets the order in which lengths are tried, and so which of equally full sequences is made.
    Same form as `best_fit`.
    """
    rng, left = np.random.default_rng(seed), counts.copy()
    present = np.flatnonzero(left)[::-1].tolist()
    made: dict[tuple, int] = {}
    while present:
        longest = present[0]
        room = capacity - longest
        left[longest] -= 1
        lengths = [x for x in present if x <= room and left[x]]
        if seed:
            lengths = [lengths[i] for i in rng.permutation(len(lengths))]
        sums, within, steps = 1, (1 << (room + 1)) - 1, []
        for x in lengths:
            rest, each = int(left[x]), 1
            while rest and not sums >> room & 1:  # numbers of pieces in powers of two
                each = min(each, rest)
                more = (sums | sums << x * each) & within
                if more != sums:
                    steps.append((x, each, sums))
                    sums = more
                rest, each = rest - each, each * 2
        at, contents = sums.bit_length() - 1, {longest: 1}
        for x, each, before in reversed(steps):
            if not before >> at & 1:
                contents[x] = contents.get(x, 0) + each
                left[x] -= each
                at -= x * each
        key = tuple(sorted(contents.items(), reverse=True))
        made[key] = made.get(key, 0) + 1
        present = [x for x in present if left[x]]
    return [(n, contents) for contents, n in made.items()]


def tightest(counts: np.ndarray, capacity: int, tries: int) -> tuple[list, bool]:
    """Best-fit decreasing, or where it is above the bound the best of `tries` fillings; certified or not."""
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    for seed in range(tries):
        if sum(n for n, _ in best) <= bound:
            break
        best = min(best, fill_sums(counts, capacity, seed), key=lambda bins: sum(n for n, _ in bins))
    return best, sum(n for n, _ in best) <= bound


#: Pieces times fillings that are tried where all that is left is in one partition.
_SEARCH = 60_000


def _plan(capacity: int, last: bool, search: bool):
    """Pack one partition: every piece gets a sequence and an offset, or is given up.

    The last round keeps all.  Before, a certified partition gives up its emptiest sequence
    only, and one above its bound every sequence with room.  `search`: the gap is worth many tries.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        length = rows.column("length").to_numpy()
        counts = np.bincount(length, minlength=capacity + 1)
        bins, certified = tightest(counts, capacity, max(1, _SEARCH // len(length)) if search else 1)
        bins = sorted((sum(x * y for x, y in c), n, c) for n, c in bins)
        order = np.argsort(length, kind="stable")
        following = np.searchsorted(length[order], np.arange(capacity + 2))
        sequence = np.full(len(length), -1, np.int64)
        offset = np.zeros(len(length), np.int64)
        filled = np.zeros(len(length), np.int64)
        number = 0
        for i, (used, many, contents) in enumerate(bins):
            given_up = 0 if last or used == capacity else (many if not certified else int(i == 0))
            held = many - given_up
            place = 0
            for size, each in contents:
                take = order[following[size] : following[size] + held * each]
                following[size] += many * each
                sequence[take] = number + np.repeat(np.arange(held), each)
                offset[take] = place + size * np.tile(np.arange(each), held)
                filled[take] = used
                place += size * each
            number += held
        return pa.table(
            {
                "row": rows.column("row"),
                "length": rows.column("length"),
                "part": pa.array(np.full(len(length), key[0].as_py()), pa.int64()),
                "local": sequence,
                "offset": offset,
                "filled": filled,
            }
        )

    return run


_PLANNED = "row long, length long, part long, local long, offset long, filled long"


def pack(
    pieces: DataFrame, capacity: int = 2048, part_rows: int = 4_000, rounds: int = 6
) -> DataFrame:
    """`pieces` (any columns, and length) with sequence_id and offset, gapless in a sequence.

    Round one deals all pieces out by hash to partitions of about `part_rows`, two at least from
    200 pieces on.  A partition whose number of sequences equals its lower bound is certified.  What
    partitions give up (see _plan) is dealt out anew to as many partitions as it needs, and packed
    again.  When it fits one partition, or after `rounds`, everything is kept.  If the whole is then above
    the bound of all pieces, the emptiest sequences, as many as one partition takes, are opened and
    packed once more while that saves one.  Lengths must be 1 to `capacity`; equal lengths are
    interchangeable, so ties do not matter.
    """
    numbered = durable(pieces.withColumn("__row", F.monotonically_increasing_id()))
    loose = numbered.select(F.col("__row").alias("row"), F.col("length").cast("long").alias("length"))
    sizes = loose.groupBy("length").count().collect()  # one row per length
    counts = np.zeros(capacity + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["count"]
    bound = lower_bound(counts, capacity)
    kept, base, turn = None, 0, 0
    while True:
        left = loose.count()
        parts = max(1, -(-left // part_rows), 2 if not turn and left >= 200 else 1)
        last = parts == 1 or turn == rounds - 1
        planned = _packed(loose, capacity, turn, base, parts, last)
        done = planned.where("local >= 0")
        kept = done if kept is None else kept.union(done)
        base, turn = base + parts, turn + 1
        if last:
            break
        loose = planned.where("local < 0").select("row", "length")
    total = _sequences(kept)
    while total > bound and turn < 2 * rounds:
        few = _emptiest(kept, part_rows)
        if few is None:
            break
        opened, rest = kept.where(F.col("filled") <= few), kept.where(F.col("filled") > few)
        again = _packed(opened.select("row", "length"), capacity, turn, base, 1, True)
        saved = _sequences(opened) - _sequences(again)
        if saved <= 0:
            break
        kept, total, base, turn = durable(rest.union(again)), total - saved, base + 1, turn + 1
    return (
        numbered.join(kept.select("row", "part", "local", "offset"), F.col("__row") == F.col("row"))
        .withColumn("sequence_id", F.col("part") * F.lit(1 << 32) + F.col("local"))
        .drop("__row", "row", "part", "local")
    )


def _packed(loose: DataFrame, capacity: int, turn: int, base: int, parts: int, last: bool) -> DataFrame:
    lane = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts)) + F.lit(base)
    plan = _plan(capacity, last, parts == 1)
    return durable(loose.select(lane.alias("part"), "row", "length").groupBy("part").applyInArrow(plan, _PLANNED))


def _sequences(planned: DataFrame) -> int:
    """Each sequence has one piece at its start."""
    return planned.where("offset = 0").count()


def _emptiest(kept: DataFrame, most: int) -> int | None:
    """Filling up to which sequences hold at most `most` pieces in all; None without any."""
    rows = kept.groupBy("filled").count().orderBy("filled").collect()
    few, pieces = None, 0
    for r in rows:  # at most one row per filling
        pieces += r["count"]
        if pieces > most:
            break
        few = r["filled"]
    return few


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the token ids of each sequence in order of offset (needs column ids)."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(pieces["ids"]).alias("ids"))
