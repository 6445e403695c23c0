"""Tokenisers, secrets, quality, language and line dedup: brute force, round trips, edge cases."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidelog.llm import bpe, langid, line_dedup, mil_quality, packing, secret_scan
from tidelog.llm import textscan as ts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = list("  \n\t\r'sstremvlld aAzZ09é中文!?.,-\u0085ß１²Ⅷ\U0001f600İſ\x1c​一Σ̀￾Ᲊ") + [
    "'s", "'RE", "'ll", " 've", "  ", "<|endoftext|>", "</w>", "\\u0041", "%41"
]


def odd_texts(seed, n=3000):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(n)]
    return [*texts, None, "", " ", "\n\n", "a" * 600, "=" * 700 + "\n" + " " * 300 + "x", "ab " * 5000]


@pytest.fixture(scope="module")
def rank_encoding():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows_of(values, counts):
    ends = np.cumsum(counts)
    return [values[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)]


def test_byte_bpe_is_the_library_and_decodes(rank_encoding):
    texts = odd_texts(1)
    codec = bpe.codec(RANKS)
    ids, counts = codec.encode(pa.array(texts))
    assert rows_of(ids, counts) == [rank_encoding.encode_ordinary(t or "") for t in texts]
    assert codec.decode(ids, counts).to_pylist() == [(t or "").encode() for t in texts]


def test_long_words_take_the_same_steps(rank_encoding):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=k)) for k in (2, 9, 40, 200)] + ["a" * 150, "ab" * 80]
    codec = bpe.Codec(RANKS, long_word=3)
    ids, counts = codec.encode_words(words)
    assert rows_of(ids, counts) == [rank_encoding.encode_ordinary(w) for w in words]


def test_a_full_cache_starts_afresh(rank_encoding):
    codec = bpe.Codec(RANKS)
    codec.words.most = 50
    texts = odd_texts(3, 300)
    ids, counts = codec.encode(pa.array(texts))
    assert rows_of(ids, counts) == [rank_encoding.encode_ordinary(t or "") for t in texts]


def test_bpe_on_frames(spark, make_docs, no_docs, rank_encoding):
    docs = make_docs((1, "hello hello"), (None, None), (3, ""), (1, "hello hello")).withColumnRenamed("lang", "ids")
    found = bpe.round_trip(docs, RANKS).collect()
    assert [r.ids for r in found] == [rank_encoding.encode_ordinary(t) for t in ("hello hello", "", "", "hello hello")]
    assert [bytes(r.decoded) for r in found] == [b"hello hello", b"", b"", b"hello hello"]
    apart = bpe.decode(bpe.encode(docs, RANKS, drop=("text",)), RANKS)
    assert [bytes(r.decoded) for r in apart.collect()] == [bytes(r.decoded) for r in found]
    assert bpe.round_trip(no_docs, RANKS).collect() == []
    bad = spark.createDataFrame([([50300],)], "ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, RANKS).collect()


def word_ids(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_word_ids_are_the_library():
    texts = odd_texts(4)
    ids, counts = packing.WordTokenizer(WORDS).encode(pa.array(texts))
    assert rows_of(ids, counts) == word_ids(texts)


def test_added_tokens_are_those_of_the_library(make_docs):
    library = Tokenizer.from_file(WORDS)
    rng = random.Random(12)
    parts = [*ALPHABET, "<|startoftext|>", "<|endoftext|>", "<|EndOfText|>", "<|endof"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|startoftext|><|endoftext|>", "e<|endoftext|>\u0301", None, "", "plain"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for some in (texts, texts[-2:], texts[-7:-5]):
        ids, counts = packing.word_tokenizer(WORDS).encode(pa.array(some))
        assert rows_of(ids, counts) == [library.encode(t or "", add_special_tokens=False).ids for t in some]
    got = {r.doc_id: r.ids for r in packing.cut_documents(make_docs(*enumerate(texts)), WORDS).collect()}
    assert got == {i: [*x, 0] for i, x in enumerate(want)}


def test_blocks_cut_between_rows_only():
    texts = ["é" * 10, None, "", "x" * 100, "y"]
    found = list(ts.blocks(pa.array(texts), most_bytes=25))
    assert [(b.first_row, b.rows) for b in found] == [(0, 3), (3, 1), (4, 1)]
    assert found[0].bounds.tolist() == [0, 10, 10, 10]


# --- packing ------------------------------------------------------------------


def test_packing_is_whole_gapless_and_certified(make_docs):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["one", "two", "cafe"], k=rng.choice([1, 9, 30, 200, 900]))) for _ in range(120)]
    texts += [None, "", "", "x " * 5000]
    docs = make_docs(*enumerate(texts))
    ids = [x + [0] for x in word_ids(texts)]
    for options in ({}, {"part_rows": 20}):
        pieces = packing.cut_documents(docs, WORDS, capacity=512)
        got = packing.pack(pieces, 512, **options).collect()
        by_doc, by_sequence = {}, {}
        for r in got:
            by_doc.setdefault(r.doc_id, []).append(r)
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for i, want in enumerate(ids):
            own = sorted(by_doc[i], key=lambda r: r.piece)
            assert [x for r in own for x in r.ids] == want
            assert [(r.piece, r.start, r.length) for r in own] == [
                (k, 512 * k, len(want[512 * k : 512 * k + 512])) for k in range(-(-len(want) // 512))
            ]
            for r in own:
                assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        for held in by_sequence.values():
            place = 0
            for offset, length in sorted(held):
                assert offset == place
                place += length
            assert place <= 512
        bound = packing.lower_bound(np.bincount([r.length for r in got], minlength=513), 512)
        assert len(by_sequence) == bound


def test_packing_of_nothing_repeats_and_clashing_names(make_docs, no_docs):
    assert packing.pack(packing.cut_documents(no_docs, WORDS)).collect() == []
    docs = make_docs((1, "a b"), (1, "a b"), (None, None)).withColumnRenamed("lang", "row").withColumnRenamed("source", "part")
    got = packing.pack(packing.cut_documents(docs, WORDS)).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (1, 3), (1, 3)]
    assert len({r.sequence_id for r in got}) == 1


def smallest_packing(lengths, capacity):
    """Fewest sequences, by trying every way."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_bounds_hold_and_best_fit_decreasing_is_that():
    rng = random.Random(6)
    for _ in range(60):
        lengths = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = np.bincount(lengths, minlength=31)
        rooms = []
        for x in lengths:
            fit = [r for r in rooms if r >= x]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - x)
            else:
                rooms.append(30 - x)
        bins = packing.best_fit(counts, 30)
        assert sum(n for n, _ in bins) == len(rooms)
        assert packing.lower_bound(counts, 30) <= smallest_packing(lengths, 30) <= len(rooms)


# --- secrets ------------------------------------------------------------------

PLAIN = "password=hunter2hunter2xx"


def hidden(text):
    return base64.b64encode(text.encode()).decode()


ESCAPED = "".join(f"\\u{ord(c):04x}" for c in PLAIN)
LAYERS = {
    "url": "".join(f"%{ord(c):02X}" for c in PLAIN),
    "unicode": ESCAPED,
    "base64": hidden(PLAIN),
    "base64>base64": hidden(hidden(PLAIN)),
    "compressed": base64.b64encode(gzip.compress(PLAIN.encode(), mtime=0)).decode(),
    "url>compressed>base64": urllib.parse.quote(
        base64.b64encode(zlib.compress(hidden(PLAIN).encode())).decode(), safe=""
    ).replace("e", "%65"),
    "base64>unicode>url": hidden("é " + "".join(f"\\x{ord(c):02x}" for c in "".join(f"%{ord(c):02X}" for c in PLAIN))),
}


@pytest.mark.parametrize("via", LAYERS)
def test_hidden_secrets_are_mapped_to_the_text(via):
    text = f"é before {LAYERS[via]} after"
    spans, unread = secret_scan.scan(text)
    decoded = [(text[a:b], kind) for a, b, kind, way in spans if way]
    assert unread == 0
    assert any(kind == "assign" and run in LAYERS[via] and len(run) > 20 for run, kind in decoded), spans


def literal_spans(text):
    """The definition, read literally."""
    either = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    names = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + "|" + either("api") + "_?" + either("key")
    assign = re.compile("(" + names + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    found = [(*m.span(), "assign") for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


def test_base_spans_by_the_letter():
    rng = random.Random(7)
    parts = ["password", "PassWd", "ſecret", "secret", "Token", "api_key", "APIKEY", ":", "=", " ", "'", '"', "abcdef0123",
             "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "é", "K", "xyz_-+/."]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert secret_scan.base_spans(text) == literal_spans(text), text
        kept = [s[:3] for s in secret_scan.scan(text)[0] if not s[3]]
        assert kept == literal_spans(text)


def test_cycles_bombs_and_clean_texts():
    assert secret_scan.scan("internationalization characteristically misunderstanding/interoperability")[0] == []
    bomb = base64.b64encode(gzip.compress(b"a" * 200_000)).decode()
    assert secret_scan.scan(f"x {bomb} y", limit=1000)[1] == 1
    assert secret_scan.scan("%25" * 50)[0] == []
    deep = PLAIN
    for _ in range(12):
        deep = hidden(deep)
    assert [s[2] for s in secret_scan.scan(deep)[0]] == ["assign"]


def packed_text(data):
    return base64.b64encode(gzip.compress(data, mtime=0)).decode()


def test_a_bomb_hides_no_other_run_and_is_read_in_windows(make_docs):
    bomb = packed_text(b"zz " * 5000)
    small = packed_text(PLAIN.encode())
    for text in (f"{small} and {bomb}", f"{bomb} and {small}"):
        spans, unread = secret_scan.scan(text, limit=1000)
        assert [text[a:b] for a, b, _, _ in spans] == [small] and unread == 1
    for fill in (b"zz ", b" " * 3):
        loaded = packed_text(fill * 5000 + b"password" + b" " * 9000 + PLAIN[8:].encode() + b" zz" * 5000)
        text = f"é {loaded} {hidden('zz ' * 9)} {loaded}"
        spans, unread = secret_scan.scan(text, limit=1000)
        assert [(text[a:b], kind) for a, b, kind, _ in spans] == [(loaded, "assign")] * 2 and unread == 2
    nested = packed_text(b"zz " * 5000 + hidden(PLAIN).encode() + b" zz" * 5000)
    assert [s[2] for s in secret_scan.scan(nested, limit=1000)[0]] == ["assign"]


def test_compressed_in_compressed_and_all_members():
    data = PLAIN.encode()
    for inner in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        for outer in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
            code = base64.b64encode(outer(outer(inner(data)))).decode()
            spans, unread = secret_scan.scan(f"é {code} end")
            assert (2, 2 + len(code), "assign") in [s[:3] for s in spans] and unread == 0
        for joint in (b"", b"\0" * 9):
            code = base64.b64encode(inner(b"one ") + joint + inner(b"two ") + joint + inner(data)).decode()
            assert (0, len(code), "assign") in [s[:3] for s in secret_scan.scan(code)[0]]
    large = gzip.compress(zlib.compress(b"zz " * 5000 + random.Random(1).randbytes(3000)) + zlib.compress(data))
    code = base64.b64encode(large).decode()
    assert (0, len(code), "assign") in [s[:3] for s in secret_scan.scan(code, limit=1000)[0]]


ODD = ["\u00a0", "\u3000", "\u200b", "\ufeff", "\u00ad", "\f", "\0", "\x1b", "\ue000", "\udcff"]  # the last is the byte FF


@pytest.mark.parametrize("odd", ODD)
def test_any_decoded_bytes_are_scanned_and_unwrapped(odd):
    for inner in (PLAIN, hidden(PLAIN), packed_text(PLAIN.encode()), LAYERS["url"]):
        data = f"中文 {odd} é {inner} {odd}".encode("utf-8", "surrogateescape")
        plain, zipped = base64.b64encode(data).decode(), packed_text(data)
        text = f"é {plain} twice {plain} zipped {zipped}"
        spans, unread = secret_scan.scan(text)
        own = [(a, b) for a, b, kind, _ in spans if kind == "assign"]
        places = [text.index(plain), text.rindex(plain), text.index(zipped)]
        for place, code in zip(places, (plain, plain, zipped), strict=True):
            assert any(place <= a < b <= place + len(code) for a, b in own)
        assert unread == 0
        if inner == PLAIN:
            at = data.index(PLAIN.encode())
            assert (2 + at // 3 * 4, 2 + (at + len(PLAIN) - 1) // 3 * 4 + 4) in own


@pytest.mark.parametrize("width, line_end", [(64, "\n"), (76, "\r\n"), (57, "\n  "), (16, "\r")])
def test_wrapped_base64_is_joined(width, line_end):
    rng = random.Random(width)
    for size in range(150, 190):
        filler = " ".join(rng.choices(["中文", "zz", "é", "yy"], k=size))
        data = f"{filler} {PLAIN} {filler}".encode()
        at = data.index(PLAIN.encode())
        packed = gzip.compress(rng.randbytes(400) + data)
        for before, after in (("x: ", " end"), ("internationalisations\n", "\nend of it"), ("-----BEGIN CERTIFICATE-----\n", "\n-----END")):
            for content in (data, packed):
                code = base64.b64encode(content).decode()
                lines = line_end.join(code[i : i + width] for i in range(0, len(code), width))
                text = f"{before}{lines}{after}"
                spans, unread = secret_scan.scan(text)
                place = [len(before) + i + i // width * len(line_end) for i in range(len(code))]
                want = (place[0], place[-1] + 1)
                if content is data:
                    want = place[at // 3 * 4], place[(at + len(PLAIN) - 1) // 3 * 4 + 3] + 1
                assert (*want, "assign") in [s[:3] for s in spans] and unread == 0, (text, spans)


def test_redaction(make_docs, no_docs):
    key = "AKIA" + "Q" * 16
    docs = make_docs((1, f"é {PLAIN} and {key} end"), (2, None), (3, ""), (4, key), (5, "plain"), (6, f"token={key}{key}"))
    got = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert got == {1: "é [SECRET] and [SECRET] end", 2: None, 3: "", 4: "[SECRET]", 5: "plain", 6: "[SECRET]"}
    assert secret_scan.redact(docs).columns == docs.columns
    assert secret_scan.redact(no_docs).collect() == []
    clash = secret_scan.find_secrets(docs.withColumnRenamed("lang", "spans")).where("doc_id = 4").first()
    assert [(s.kind, s.start, s.end) for s in clash.spans] == [("access", 0, 20)]


# --- language -----------------------------------------------------------------

SENTENCES = {
    "en": "the house is near the river and the children are playing with their friends in the garden",
    "de": "das haus steht am fluss und die kinder spielen mit ihren freunden im garten hinter der schule",
    "fr": "la maison est près de la rivière et les enfants jouent avec leurs amis dans le jardin",
}


def spoken(rng, lang, n):
    return " ".join(rng.choices(SENTENCES[lang].split(), k=n))


def test_languages_of_known_and_unseen_words(make_docs):
    rng = random.Random(8)
    rows = [(i, spoken(rng, lang, 20), lang, "s") for i in range(60) for lang in (rng.choice(list(SENTENCES)),)]
    rows += [(900, None, "en", "s"), (901, "the the", None, "s"), (902, "", "de", "s")]
    model = langid.train(make_docs(*rows), least_count=1)
    assert model.languages == ["de", "en", "fr"]
    asked = [(1, "the children"), (2, "kinderspiele"), (3, "rivières"), (4, None), (5, "12 + 34"), (6, ""), (7, "gardens")]
    got = {r.doc_id: r for r in langid.predict(make_docs(*asked), model).collect()}
    assert {k: r.lang_pred for k, r in got.items()} == {1: "en", 2: "de", 3: "fr", 4: "und", 5: "und", 6: "und", 7: "en"}
    assert all(0 <= r.score <= 1 for r in got.values()) and got[4].score == 0


def test_language_counts_by_hand(make_docs):
    docs = make_docs((1, "ab AB b", "x", "s"), (2, "ab", "y", "s"), (2, "ab", "y", "s"))
    model = langid.train(docs, longest=2, least_count=1)
    block = next(ts.blocks(pa.array(["ab b a^c zz"])))
    words = langid.read_words(block)
    scores = model.word_scores(words)
    # Words: x has ab twice and b once, y has ab twice; both words are kept, half a count is added.
    assert np.exp(scores[0]) == pytest.approx([2.5 / 4, 2.5 / 3])
    assert np.exp(scores[1]) == pytest.approx([1.5 / 4, 0.5 / 3])
    assert (scores[-1] == 0).all()  # nothing of zz is known


def test_what_occurs_once_counts(make_docs):
    docs = make_docs((1, "the house the house", "en", "s"), (2, "fjord", "no", "s"), (3, "12", "xx", "s"))
    model = langid.train(docs)
    assert model.languages == ["en", "no"]
    got = langid.predict(make_docs((1, "fjord"), (2, "house")), model).collect()
    assert [r.lang_pred for r in got] == ["no", "en"]


def test_words_that_are_not_at_hand_are_joined(make_docs):
    rng = random.Random(13)
    rows = [(i, spoken(rng, lang, 20), lang, "s") for i in range(40) for lang in (rng.choice(list(SENTENCES)),)]
    asked = [(i, " ".join(rng.choices([*SENTENCES["en"].split(), *SENTENCES["de"].split(), "gärten", "rivieras", "ζζζ", "中文"], k=rng.randint(0, 8)))) for i in range(60)]
    asked += [(100, None), (101, "12"), (102, "ζζζ"), (102, "ζζζ"), (None, "the")]
    full = langid.train(make_docs(*rows))
    want = langid.predict(make_docs(*asked), full).collect()
    for cells in (1, 40, 200):
        model = langid.train(make_docs(*rows), max_cells=cells)
        got = langid.predict(make_docs(*asked), model).collect()
        order = lambda rs: sorted((repr(r.doc_id), r.text or "", r.lang_pred, r.score) for r in rs)
        for a, b in zip(order(got), order(want), strict=True):
            assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-5)
    assert got[0].asDict().keys() == want[0].asDict().keys()


def test_a_model_of_nothing(no_docs, make_docs):
    model = langid.train(no_docs)
    got = langid.predict(make_docs((1, "hello")).withColumnRenamed("lang", "score"), model).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert langid.predict(no_docs, model).collect() == []


# --- quality ------------------------------------------------------------------


def graded(rng, n):
    good = lambda: " ".join(rng.choices("a quiet morning by the old river, where boats pass slowly.".split(), k=150))
    bad = lambda: " ".join(w.upper() + "!!" for w in rng.choices("buy now cheap offer click".split(), k=150))
    return [(i, good() if i % 3 else bad(), i % 3 > 0) for i in range(n)]


def test_quality_is_learned_from_documents(spark, make_docs, no_docs):
    rng = random.Random(9)
    rows = graded(rng, 240)
    docs = make_docs(*((i, t) for i, t, _ in rows), (1000, None), (1001, ""), (1002, "ok"))
    labels = spark.createDataFrame(
        [*((i, int(q)) for i, _, q in rows if i < 160), (5, None), (None, 1)], "doc_id long, quality int"
    )
    model = mil_quality.train(docs, labels)
    got = {r.doc_id: r.score for r in mil_quality.score(docs, model).collect()}
    held_out = [(got[i] >= 0.5) == q for i, _, q in rows if i >= 160]
    assert np.mean(held_out) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 243
    again = mil_quality.train(docs, labels)
    assert all(np.array_equal(again.weights[k], v) for k, v in model.weights.items())
    assert mil_quality.score(no_docs, model).collect() == []


def test_quality_without_labels_or_with_one_class(spark, make_docs):
    docs = make_docs((1, "a"), (2, "b"))
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert mil_quality.train(docs, empty).constant == 0.5
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    clash = docs.withColumnRenamed("lang", "score").withColumnRenamed("source", "features")
    assert [r.score for r in mil_quality.score(clash, mil_quality.train(clash, ones)).collect()] == [1.0, 1.0]


def test_attention_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(10)
    many = np.array([3, 1, 4])
    features = rng.standard_normal((8, mil_quality.WIDTH))
    label, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    model = mil_quality.fit(features, many, label, weight, epochs=1)

    def loss():
        p = mil_quality._sigmoid(model.forward(features, many)["logit"])
        return -(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() / weight.sum()

    slopes = model.gradient(features, many, label, weight)
    for name, slope in slopes.items():
        w = model.weights[name] = np.array(model.weights[name], float)
        for place in [tuple(rng.integers(s) for s in w.shape) for _ in range(4)]:
            kept = w[place]
            w[place] = kept + 1e-5
            above = loss()
            w[place] = kept - 1e-5
            below = loss()
            w[place] = kept
            assert slope[place] == pytest.approx((above - below) / 2e-5, abs=1e-6)


# --- lines --------------------------------------------------------------------


def lines_by_hand(rows, ratio, least):
    pages, found = {}, {}
    for _, text, _, host in rows:
        if host is not None:
            pages[host] = pages.get(host, 0) + 1
            for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
                found[host, line] = found.get((host, line), 0) + 1

    def drop(host, line):
        n = found.get((host, line.strip(" ")), 0)
        return host is not None and line.strip(" ") and n >= least and n > ratio * pages[host]

    return [
        (i, None if text is None else "\n".join(x for x in text.split("\n") if not drop(host, x))) for i, text, _, host in rows
    ]


def test_lines_by_hand(make_docs, no_docs):
    rng = random.Random(11)
    pool = ["share this", " share this ", "", "menu", "footer é", "unique"]
    rows = []
    for i in range(150):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"text {rng.randint(0, 60)}" for _ in range(rng.randint(0, 6))]
        rows.append((i, "\n".join(lines), "en", rng.choice(["a", "a", "b", "tiny", None])))
    rows += [(500, None, "en", "a"), (501, "", "en", "b"), (3, rows[3][1], "en", rows[3][3]), (None, "menu", "en", "a")]
    for options in ({"ratio": 0.1, "min_pages": 5}, {"ratio": 0.02, "min_pages": 2, "salts": 3}):
        want = lines_by_hand(rows, options["ratio"], options["min_pages"])
        docs = make_docs(*rows).withColumnRenamed("lang", "boilerplate")
        got = [(r.doc_id, r.text) for r in line_dedup.drop_boilerplate(docs, **options).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert line_dedup.drop_boilerplate(no_docs).collect() == []


def test_line_keys_do_not_clash_with_columns(make_docs):
    docs = make_docs(*((i, "menu\nown " + str(i)) for i in range(10))).withColumnRenamed("lang", "lines_dropped")
    got = line_dedup.drop_boilerplate(docs).collect()
    assert [r.lines_dropped for r in got] == [1] * 10
    assert hashlib.sha256("".join(sorted(r.text for r in got)).encode()).hexdigest() == hashlib.sha256(
        "".join(sorted(f"own {i}" for i in range(10))).encode()
    ).hexdigest()
