"""Secrets in texts, also behind layers of encoding.

Each text is a worklist of layers.  A layer is scanned, then unwrapped by each decoder (percent
escapes, Unicode escapes, base64, base64 of compressed bytes); every text that comes out and has
not been seen for this document is a new layer, until none is left.  Every character of a layer
knows the range of the original text that it stands for, so what is found in a layer is
reported where it lies in the document.
"""

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import textscan as ts

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Both match whole runs, so a run that is long enough is exactly a match that is kept.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_BLANKS = re.compile(rb"  +")
_PIECE, _WINDOW = 1 << 20, 4 << 20
#: Lines of symbols alone; the first may follow and the last precede other text.
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*(?:\r\n?|\n)[ \t]*[A-Za-z0-9+/_-]++)++={0,2}"
)
_SYMBOLS = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_URL_SAFE = str.maketrans("-_", "+/")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("via", T.StringType()),
    ]
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets in one text; leftmost, non-overlapping per kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Layer:
    """A decoded text; character i stands for the original from start[i] to end[i]."""

    text: str
    start: np.ndarray
    end: np.ndarray
    via: str

    def original(self, lo: int, hi: int) -> tuple[int, int]:
        return int(self.start[lo:hi].min()), int(self.end[lo:hi].max())


@dataclass
class Run:
    """Code from start to end of a layer, and the text that it stands for.

    Character i of the text comes from first[i] to last[i] of the layer.  A run in `place` is
    read instead of its code; another one is a layer of its own.
    """

    start: int
    end: int
    text: str
    first: np.ndarray
    last: np.ndarray
    place: bool = True


def _by_bytes(start: int, data: bytes, text: str, first: np.ndarray, last: np.ndarray) -> tuple:
    """Source range of every character of `data`, from the range of each byte."""
    if len(text) == len(data):
        return start + first, start + last
    raw = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    final = np.append(lead[1:], len(raw)) - 1
    return start + first[lead], start + last[final]


def _percent(layer: Layer, limit: int, unread: set) -> Iterator[Run]:
    text = layer.text
    if "%" not in text:
        return
    for m in _PERCENT.finditer(text):
        data = bytes.fromhex(m[0].replace("%", ""))
        try:
            decoded = data.decode("utf-8")
        except UnicodeDecodeError:
            data = data.decode("latin-1").encode("utf-8")
            decoded = data.decode("utf-8")
            at = 3 * np.arange(len(decoded))
            yield Run(m.start(), m.end(), decoded, m.start() + at, m.start() + at + 3)
            continue
        at = 3 * np.arange(len(data))
        yield Run(m.start(), m.end(), decoded, *_by_bytes(m.start(), data, decoded, at, at + 3))


def _unicode(layer: Layer, limit: int, unread: set) -> Iterator[Run]:
    text = layer.text
    if "\\" not in text and "&#" not in text:
        return
    high = None  # first half of a surrogate pair: (code, start, end)
    for m in _UNICODE.finditer(text):
        body = m[0]
        if body[0] == "&":
            code = int(body[3:-1], 16) if body[2] in "xX" else int(body[2:-1])
        else:
            code = int(body[2:], 16)
        if 0xD800 <= code < 0xDC00:
            high = (code, m.start(), m.end())
            continue
        start = m.start()
        if 0xDC00 <= code < 0xE000:
            if not high or high[2] != start:
                continue
            code, start = 0x10000 + ((high[0] - 0xD800) << 10) + code - 0xDC00, high[1]
        if code < 0x110000:
            yield Run(start, m.end(), chr(code), np.array([start]), np.array([m.end()]))


def _tool(data: bytes):
    """A decompressor for gzip, zlib, bzip2 or xz data; None for other bytes."""
    if data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2]) % 31 == 0):
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _inflate(pieces: Iterable[bytes], rest: list[int] | None = None) -> Iterator[bytes]:
    """The content of compressed data, all members of the stream, as far as it can be read.

    `rest` gets the number of bytes that follow the last member in its piece.
    """
    pieces = iter(pieces)
    data, tool = b"", None
    try:
        while True:
            if tool is None or tool.eof:
                data = tool.unused_data.lstrip(b"\0") if tool else b""
                while len(data) < 6 and (more := next(pieces, None)) is not None:
                    data += more
                tool = _tool(data)
                if tool is None:
                    if rest is not None:
                        rest.append(len(data))
                    return
            out = tool.decompress(data, _PIECE)
            data = getattr(tool, "unconsumed_tail", b"")
            if out:
                yield out
            elif not data and not tool.eof:
                data = next(pieces, None)
                if data is None:
                    return
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return


def _unused(data: bytes, limit: int) -> int:
    """How many bytes follow compressed data; 0 if it goes on beyond `limit` or is cut short."""
    size = 0
    pieces = _inflate([data], rest := [])
    for piece in pieces:
        size += len(piece)
        if size > limit:
            return 0
    return rest[0] if size and rest else 0


def _contents(data: bytes, limit: int) -> Iterator[tuple[bytes | Iterable[bytes], bool]]:
    """The content of compressed data and, as long as that is compressed as well, its content.

    Content of up to `limit` bytes comes whole, with whether it is the last; a larger one in
    pieces.  Content that is its own content ends there.
    """
    seen = {hashlib.sha256(data).digest()}

    def source() -> Iterable[bytes]:
        return [data]

    while True:
        held, size, pieces = [], 0, _inflate(source())
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size > limit:
                break
        content = b"".join(held)
        digest = hashlib.sha256(content).digest()
        if not content or digest in seen:
            return
        seen.add(digest)
        if size > limit:
            yield itertools.chain([content], pieces), False
            source = partial(lambda outer: _inflate(outer()), source)
        else:
            yield content, next(_inflate([content]), None) is None
            source = partial(list, [content])


def _windows(pieces: Iterable[bytes], size: int) -> Iterator[bytes]:
    """Windows of `size` bytes; the latter half of each is the first of the next.

    Blanks in a row become one, which is the same to every pattern: a match that counts is
    short, and no cut loses it.
    """
    held = b""
    for piece in pieces:
        held = _BLANKS.sub(b" ", held + piece)
        while len(held) >= size:
            yield held[:size]
            held = held[size - size // 2 :]
    if held:
        yield held


def _text(data: bytes) -> tuple[str, bool]:
    """Bytes as text, and whether they are one: UTF-8 without control characters.

    Bytes that are not UTF-8 are taken for Latin-1, so that what is ASCII in them is found.
    """
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1"), False
    return text, not _CONTROL.search(text)


def _dull(text: str) -> bool:
    """Nothing is found in the text and no decoder has anything to read."""
    return not (_PERCENT.search(text) or _UNICODE.search(text) or _BASE64.search(text) or base_spans(text))


def _base64_bytes(run: str) -> bytes | None:
    body = run.rstrip("=").translate(_URL_SAFE)
    if len(body) % 4 == 1:
        return None
    return base64.b64decode(body + "=" * (-len(body) % 4))


@dataclass
class Code:
    """Symbols that may be base64, the bytes they stand for, and the place of each symbol."""

    place: np.ndarray
    data: bytes
    wrapped: bool = False

    @property
    def start(self) -> int:
        return int(self.place[0])

    def end(self, unused: int = 0) -> int:
        """Where the code ends, without the symbols of the last `unused` bytes."""
        most = -(-(len(self.data) - unused) * 4 // 3) if unused else len(self.place)
        return int(self.place[most - 1]) + 1


def _wrapped_runs(text: str) -> Iterator[Code]:
    """Runs over lines: whole blocks from wherever they may begin, and lines of one width with the
    shorter one that ends them."""
    for m in _WRAPPED.finditer(text):
        lines = [x.span() for x in _SYMBOLS.finditer(text, *m.span())]
        symbols = "".join(text[lo:hi] for lo, hi in lines)
        place = np.concatenate([np.arange(lo, hi) for lo, hi in lines])
        width = [hi - lo for lo, hi in lines]
        at = [0, *itertools.accumulate(width)]
        n, aligned, chosen = len(lines), set(), set()
        for i in range(n - 1):
            # Blocks from lines a multiple of four symbols apart read the same, but for compressed bytes.
            head = _base64_bytes(symbols[at[i] : at[i] + 8].rstrip("="))
            if at[i] % 4 not in aligned or (head and _tool(head)):
                aligned.add(at[i] % 4)
                chosen.add((i, n))
        for _, group in itertools.groupby(range(n), lambda i: width[i]):
            group = [*group]
            i, j = group[0], group[-1] + 1
            if j - i > 1:
                chosen.add((i, j))
            if j < n and width[j] < width[i] and width[i] >= 16:
                chosen.add((i, j + 1))
        for i, j in chosen:
            run = symbols[at[i] : at[j]]
            if len(run.rstrip("=")) % 4 == 1:
                run = run.rstrip("=")[:-1]
            yield Code(place[at[i] : at[i] + len(run)], _base64_bytes(run) or b"", True)


def _base64_runs(text: str) -> list[Code]:
    """Runs that may be base64, by start, the longest first: wrapped ones, whole ones of one line,
    and the parts between signs of their alphabet."""
    found = [*_wrapped_runs(text)]
    for m in _BASE64.finditer(text):
        for part in (m, *re.finditer(r"[A-Za-z0-9]{16,}={0,2}", m[0])):
            lo = m.start() + (0 if part is m else part.start())
            if (part is m or part[0] != m[0]) and (data := _base64_bytes(part[0])) is not None:
                found.append(Code(np.arange(lo, lo + len(part[0])), data))
    return sorted(found, key=lambda c: (c.start, -c.end()))


def _base64(layer: Layer, limit: int, unread: set) -> Iterator[Run]:
    for code in _base64_runs(layer.text):
        decoded, plain = _text(code.data)
        if plain or not _dull(decoded):
            at = np.arange(len(code.data)) // 3 * 4
            first, last = code.place[at], code.place[np.minimum(at + 3, len(code.place) - 1)] + 1
            yield Run(code.start, code.end(), decoded, *_by_bytes(0, code.data, decoded, first, last), plain)


def _compressed(layer: Layer, limit: int, unread: set) -> Iterator[Run]:
    """Content of up to `limit` bytes in place; more than that in windows, each on its own."""
    for code in _base64_runs(layer.text):
        start, data = code.start, code.data
        if _tool(data) is None:
            continue
        # A block of lines may go on after the code.
        end = code.end(_unused(data, limit) if code.wrapped else 0)
        key = (*layer.original(start, end), hashlib.sha256(data).digest())
        if key in unread:  # met in a layer before
            continue
        for content, final in _contents(data, limit):
            if isinstance(content, bytes):
                decoded, plain = _text(content)
                if plain or not _dull(decoded):
                    n = len(decoded)
                    yield Run(start, end, decoded, np.full(n, start), np.full(n, end), plain and final)
                continue
            unread.add(key)
            for window in _windows(content, max(2, min(limit, _WINDOW))):
                text = window.decode("utf-8", "replace")
                yield Run(start, end, text, np.full(len(text), start), np.full(len(text), end), False)


DECODERS = {"url": _percent, "unicode": _unicode, "base64": _base64, "compressed": _compressed}


def unwrap(layer: Layer, name: str, limit: int, unread: set) -> Iterator[Layer]:
    """What the decoder reads in a layer: runs that are layers, then the layer with all others in place."""
    via = f"{layer.via}>{name}" if layer.via else name
    texts, starts, ends, at = [], [], [], 0
    for run in DECODERS[name](layer, limit, unread):
        first, last = run.first, run.last - 1
        if not run.place:
            yield Layer(run.text, layer.start[first], layer.end[last], via)
        elif run.start >= at:
            texts += [layer.text[at : run.start], run.text]
            starts += [layer.start[at : run.start], layer.start[first]]
            ends += [layer.end[at : run.start], layer.end[last]]
            at = run.end
    if texts:
        yield Layer(
            "".join([*texts, layer.text[at:]]),
            np.concatenate([*starts, layer.start[at:]]),
            np.concatenate([*ends, layer.end[at:]]),
            via,
        )


def scan(text: str, limit: int = 64 << 20) -> tuple[list[tuple[int, int, str, str]], int]:
    """(start, end, kind, via) of all secrets of a text, and the number of unread layers.

    `via` is empty for what the text shows itself.  A span that several layers show counts once.
    Compressed content of more than `limit` bytes is read in windows that overlap by half.  It
    is counted as unread, for encoded runs in it are only whole up to half a window.
    """
    found = {(lo, hi, kind): "" for lo, hi, kind in base_spans(text)}
    unread: set = set()
    seen = set()

    def opened(layer: Layer) -> Iterator[Layer]:
        for name in DECODERS:
            for inner in unwrap(layer, name, limit, unread):
                digest = hashlib.sha256(inner.text.encode("utf-8", "surrogatepass")).digest()
                key = (digest, int(inner.start[0]), int(inner.end[-1])) if inner.text else None
                if key and key not in seen:  # a layer met before, as in a cycle, is not opened again
                    seen.add(key)
                    yield inner

    work: list[Iterator[Layer]] = []
    if "%" in text or "\\" in text or "&#" in text or _BASE64.search(text):
        at = np.arange(len(text))
        seen.add((hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), 0, len(text)))
        work.append(opened(Layer(text, at, at + 1, "")))
    while work:  # depth first, so that windows are made one at a time
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        for lo, hi, kind in base_spans(layer.text):
            found.setdefault((*layer.original(lo, hi), kind), layer.via)
        work.append(opened(layer))
    order = sorted(found.items(), key=lambda x: (x[0][0], KINDS.index(x[0][2]), x[0][1]))
    return [(*span, via) for span, via in order], len(unread)


def find_secrets(df: DataFrame, text: str = "text", limit: int = 64 << 20) -> DataFrame:
    """`df` with spans, an array of (kind, start, end, via), and unread_layers.

    Positions are code points of `text`, the end exclusive; `via` names the layers that hid the
    span, outermost first, and is empty for spans of the text itself.  Spans come by start, then
    kind in the order of KINDS, then end.  Null and empty texts have none.  Columns that are
    called spans or unread_layers are replaced.
    """
    fields = [f for f in df.schema.fields if f.name not in ("spans", "unread_layers")]
    schema = T.StructType(
        [*fields, T.StructField("spans", T.ArrayType(SPAN)), T.StructField("unread_layers", T.LongType())]
    )
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("via", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.each(batches):
            rows = [scan(value.as_py() or "", limit) for value in batch.column(text)]
            spans = [
                [{"kind": k, "start": lo, "end": hi, "via": via} for lo, hi, k, via in found]
                for found, _ in rows
            ]
            kept = {f.name: batch.column(f.name) for f in fields}
            kept["spans"] = pa.array(spans, kind)
            kept["unread_layers"] = pa.array([unread for _, unread in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([*kept.values()], names=[*kept])

    return df.mapInArrow(run, schema)


def redact(df: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """`df` with every span of every layer in `text` replaced by `mask`; null texts stay null.

    Spans that overlap or touch are masked as one.  A `spans` column may say what to mask, else
    it is found first.
    """
    found = df if "spans" in df.columns else find_secrets(df, text)

    def step(state: Column, span: Column) -> Column:
        """Kept text so far, and where the next kept part begins."""
        fresh = span["start"] > state["at"]
        part = F.substring(F.col(text), state["at"] + 1, span["start"] - state["at"])
        begin = F.when(fresh, F.concat(state["kept"], part, F.lit(mask)))
        # The first span may begin the text; later ones that touch the last are part of it.
        first = (state["at"] == 0) & (state["kept"] == "")
        kept = begin.when(first, F.lit(mask)).otherwise(state["kept"])
        return F.struct(kept.alias("kept"), F.greatest(state["at"], span["end"]).alias("at"))

    start = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    masked = F.aggregate(
        "spans",
        start,
        step,
        lambda s: F.concat(s["kept"], F.substring(F.col(text), s["at"] + 1, F.length(text))),
    )
    out = found.withColumn(text, F.when(F.size("spans") > 0, masked).otherwise(F.col(text)))
    return out if "spans" in df.columns else out.drop("spans", "unread_layers")
