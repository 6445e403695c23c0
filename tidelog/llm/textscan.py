"""Texts as flat code point arrays, cut into tokens and hashed without a loop over tokens."""

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers.normalizers import Lowercase

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, giving what the one before took back to the system: workers live on between stages."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim is not None:
            trim(0)


@dataclass
class Block:
    """Some rows of a batch: code points one after another, row i at bounds[i] to bounds[i+1]."""

    first_row: int
    codes: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def blocks(texts: pa.Array, most_bytes: int = 1_000_000) -> Iterator[Block]:
    """Whole rows in blocks of about `most_bytes`; a longer row is a block of its own.

    What is worked out for a block takes some 60 bytes per byte of text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most_bytes, "right")) - 1)
        hi = min(hi, len(texts))
        part = data[ends[lo] : ends[hi]]
        codes = np.frombuffer(part.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        before = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80, dtype=np.int64)])
        yield Block(lo, codes, before[ends[lo : hi + 1] - ends[lo]])
        lo = hi


def _all_characters(skip: tuple = ()) -> str:
    return "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c not in skip)


@cache
def classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER of every code point, by the tokenizers' own Unicode tables.

    An encoding of single bytes drops whatever its pattern does not match.
    """
    table = np.zeros(0x110000, np.uint8)
    every, single = _all_characters(), {bytes([i]): i for i in range(256)}
    for value, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(probe.encode_ordinary(every)).decode("utf-8")
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = value
    return table


@cache
def lower() -> np.ndarray:
    """Lower case of every code point; U+0130 has two and stays here."""
    table = np.arange(0x110000, dtype=np.uint32)
    upper = _all_characters(skip=(0x130,))
    small = Lowercase().normalize_str(upper)
    codes, lowered = (np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (upper, small))
    table[codes] = lowered
    return table


@cache
def _code_hashes() -> np.ndarray:
    return np.random.default_rng(20_250_101).integers(0, 2**64, 0x110000, dtype=np.uint64)


@cache
def _powers(n: int) -> np.ndarray:
    steps = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed, invertible mixer)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def row_starts(block: Block) -> np.ndarray:
    """True where a row begins."""
    first = np.zeros(len(block.codes) + 1, bool)
    first[block.bounds[:-1]] = True
    return first[:-1]


def hash_spans(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; spans lie edge to edge and the first starts at 0."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(codes)))
    place = np.arange(len(codes), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    longest = 1 << int(lengths.max() - 1).bit_length() if lengths.max() > 1 else 1
    terms = _code_hashes()[codes] * _powers(max(64, longest))[place]
    return mix(np.add.reduceat(terms, starts) + lengths.astype(np.uint64))


def _contractions(codes: np.ndarray, kind: np.ndarray, first: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Positions of apostrophes that take letters with them, and how many, as two arrays.

    The apostrophe must be a run of its own and the letters follow in the same row:
    's 't 're 've 'm 'll 'd, in lower case.
    """
    n = len(codes)
    at = np.flatnonzero((codes == 0x27) & run)
    at = at[at + 1 < n]
    at = at[(kind[at + 1] == LETTER) & ~first[at + 1]]
    a = codes[at + 1]
    more = np.minimum(at + 2, n - 1)
    b = np.where((at + 2 < n) & ~first[more] & (kind[more] == LETTER), codes[more], 0)
    o = {c: ord(c) for c in "stremvld"}
    two = ((a == o["r"]) & (b == o["e"])) | ((a == o["v"]) & (b == o["e"])) | ((a == o["l"]) & (b == o["l"]))
    one = (a == o["s"]) | (a == o["t"]) | (a == o["m"]) | (a == o["d"])
    taken = np.where(one, 1, np.where(two, 2, 0))
    return np.stack([at[taken > 0], taken[taken > 0]])


def _runs(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = classes()[codes]
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    return kind, run


def spaced_tokens(block: Block) -> np.ndarray:
    """Start of every token of the pattern that keeps a space with the token after it.

    's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|spaces not before a token|spaces
    """
    codes, first = block.codes, row_starts(block)
    if not len(codes):
        return np.zeros(0, np.int64)
    kind, run = _runs(codes, first)
    start = run.copy()
    # The last white space before a token of the same row: a blank joins it, another is alone.
    ahead = np.flatnonzero(run[1:] & (kind[:-1] == SPACE) & ~first[1:])
    start[ahead] = True
    joined = ahead[codes[ahead] == 0x20]
    start[joined + 1] = False
    alone = run & (kind == OTHER)
    alone[1:][(kind[:-1] == SPACE) & (codes[:-1] == 0x20) & ~first[1:]] = False
    at, taken = _contractions(codes, kind, first, alone)
    start[at + 1] = False
    after = at + 1 + taken
    inside = after < len(codes)
    start[after[inside]] = True
    return np.flatnonzero(start)


def bare_tokens(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every span, and whether it is a token, of the pattern without white space.

    's|'t|'re|'ve|'m|'ll|'d|letters|one number|others
    """
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    kind, run = _runs(codes, first)
    start = run | (kind == NUMBER)
    at, taken = _contractions(codes, kind, first, run)
    start[at + 1] = False
    after = at + 1 + taken
    inside = after < len(codes)
    start[after[inside]] = True
    begins = np.flatnonzero(start)
    return begins, kind[begins] != SPACE


def strings(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The spans as text."""
    raw = codes.astype("<u4").tobytes().decode("utf-32-le")
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each span, one span after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    offsets = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - offsets, lengths)


class _Level:
    """Sorted word hashes, with the place and number of each word's ids."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        return place, self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), bool)

    def add(self, keys: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.start = np.concatenate([self.start, start])[order]
        self.length = np.concatenate([self.length, length.astype(np.int32)])[order]


class TokenCache:
    """Ids of words by their hash, for one Python worker; starts afresh beyond `most` words.

    New words go to a small level, which joins the large one when it has grown to a fifth of it.
    """

    def __init__(self, encode, most: int = 600_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.large, self.small = _Level(), _Level()
        self.ids = np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.large.keys) + len(self.small.keys)

    def lookup(self, hashes: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids of each (distinct) hash; `words(index)` gives unknown words."""
        if len(self) + len(hashes) > self.most:
            self.clear()
        start, length = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        left = np.arange(len(hashes))
        for level in (self.large, self.small):
            place, known = level.find(hashes[left])
            start[left[known]] = level.start[place[known]]
            length[left[known]] = level.length[place[known]]
            left = left[~known]
        if len(left):
            ids, lengths = self.encode(words(left))
            start[left] = len(self.ids) + np.cumsum(lengths) - lengths
            length[left] = lengths
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.small.add(hashes[left], start[left], lengths)
            if len(self.small.keys) > max(20_000, len(self.large.keys) // 5):
                self.large.add(self.small.keys, self.small.start, self.small.length)
                self.small = _Level()
        return start, length


def encode_tokens(cache: TokenCache, codes: np.ndarray, starts: np.ndarray, wanted: np.ndarray | None):
    """Ids of all tokens one after another, and the number of ids of each span."""
    import pandas as pd

    hashes = hash_spans(codes, starts)
    ends = np.append(starts[1:], len(codes))
    if wanted is not None:
        hashes, at, to = hashes[wanted], starts[wanted], ends[wanted]
    else:
        at, to = starts, ends
    which, distinct = pd.factorize(hashes)
    sample = np.zeros(len(distinct), np.int64)
    sample[which[::-1]] = np.arange(len(which))[::-1]
    place, length = cache.lookup(distinct, lambda new: strings(codes, at[sample[new]], to[sample[new]]))
    ids = cache.ids[ragged(place[which], length[which])]
    if wanted is None:
        return ids, length[which]
    counts = np.zeros(len(starts), np.int64)
    counts[wanted] = length[which]
    return ids, counts


def per_row(counts: np.ndarray, starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the spans' counts for each row."""
    running = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(running[np.searchsorted(starts, bounds)])
