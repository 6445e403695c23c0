"""Every opN query over whole tables against brute force; those with SQL are compared elsewhere."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.test_join_archive_pipeline import SF_DIR, groups_by_hand
from tests.llm.test_text_operators import literal_spans
from tests.llm.test_vectors import components_by_hand, links_by_hand, neighbours_by_hand
from tidelog.llm import packing, secret_scan
from tidelog.llm.queries import QUERIES


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_op1(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, "embeddings")]
    links = links_by_hand(rows, 0.98)
    parts = components_by_hand(links)
    got = {tuple(r) for r in QUERIES["op1_pq_dedup"](spark, SF_DIR).collect()}
    assert got == {(i, len(links[i]), parts[i], parts[i] == i) for i in links}


def test_op2(spark):
    want = groups_by_hand([(r.doc_id, r.text) for r in table(spark, "documents")], 3, "0.9")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_ngram_join"](spark, SF_DIR).collect()}
    assert got == want


def test_op3(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for r in table(spark, "documents"):
        ids = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(r.text or "")))
    assert {tuple(r) for r in QUERIES["op3_bpe"](spark, SF_DIR).collect()} == want


def test_op4(spark):
    got = {r.doc_id: r for r in QUERIES["op4_secret_scan"](spark, SF_DIR).collect()}
    for r in table(spark, "documents"):
        base = literal_spans(r.text or "")
        row = got[r.doc_id]
        listed = ",".join(f"{kind}:{lo}:{hi}" for lo, hi, kind in base)
        assert row.base_sha256 == sha(listed)
        assert [row[f"n_{k}"] for k in secret_scan.KINDS] == [sum(s[2] == k for s in base) for k in secret_scan.KINDS]
        spans = row.spans.split(",") if row.spans else []
        assert set(listed.split(",")) - {""} <= set(spans) and len(spans) == len(base) + row.n_decoded


@pytest.mark.parametrize("name, divisor, remainder", [("op5_mil_quality", 5, 0), ("op6_langid", 3, 1)])
def test_op5_and_op6(spark, name, divisor, remainder):
    got = {r.doc_id: r for r in QUERIES[name](spark, SF_DIR).collect()}
    docs = table(spark, "documents")
    assert set(got) == {r.doc_id for r in docs}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % divisor == remainder) and 0 <= r.score <= 1
    if name == "op5_mil_quality":
        truth = {r.doc_id: r.quality for r in table(spark, "labels")}
        assert all(r.predicted == (r.score >= 0.3) for r in got.values())
        right = [got[i].predicted == q for i, q in truth.items() if got[i].held_out]
    else:
        right = [got[r.doc_id].lang_pred == r.lang for r in docs if r.lang and got[r.doc_id].held_out]
    assert np.mean(right) > 0.9


def test_op9(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, "embeddings")]
    want = neighbours_by_hand(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = {tuple(r)[:3] for r in QUERIES["op9_onebit_ann"](spark, SF_DIR).collect()}
    assert len(got) == len(want) and len(got & want) >= 0.99 * len(want)


def test_op10(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, lengths = set(), []
    for r in table(spark, "documents"):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            lengths.append(len(piece))
            want.add((r.doc_id, start // 2048, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())))
    rows = QUERIES["op10_best_fit_packing"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    place = dict.fromkeys((r.sequence_id for r in rows), 0)
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == place[r.sequence_id]
        place[r.sequence_id] += r.length
    assert max(place.values()) <= 2048
    bound = packing.lower_bound(np.bincount(lengths, minlength=2049), 2048)
    assert len(place) == bound
