"""Nearest labelled examples against plain counting and all cosines."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from tests.llm.test_join_archive_pipeline import SF_DIR
from tidelog.llm import textscan, toxicity
from tidelog.llm.queries import QUERIES

LABELS = "doc_id long, toxic int, score double"


def words_of(text):
    return Counter(w.lower() for w in regex.findall(r"\p{L}+", text or ""))


def hash_of(word):
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    return int(textscan.hash_spans(codes, np.zeros(1, np.int64)).view(np.int64)[0])


def vocabulary_by_hand(docs, labels, evidence, lift):
    """word -> inverse document frequency, for few labels (all are examples)."""
    bags = [(words_of(t), labels[i]) for i, t in docs if i in labels]
    n1, n = sum(y for _, y in bags), len(bags)
    n0 = n - n1
    ones, zeros, everywhere = Counter(), Counter(), Counter()
    for bag, y in bags:
        (ones if y else zeros).update(bag.keys())
    for _, t in docs:
        everywhere.update(words_of(t).keys())
    chosen = {}
    for w in ones.keys() | zeros.keys():
        a, b = ones[w], zeros[w]
        cells = [(a, (a + b) * n1 / n), (b, (a + b) * n0 / n)]
        cells += [(n1 - a, (n - a - b) * n1 / n), (n0 - b, (n - a - b) * n0 / n)]
        g = 2 * sum(x * math.log(x / e) for x, e in cells if x)
        rates = (a + 0.5) / n1, (b + 0.5) / n0
        if g >= evidence and max(rates[0] / rates[1], rates[1] / rates[0]) >= lift:
            chosen[w] = math.log((len(docs) + 1) / everywhere[w])
    return chosen


def vector(bag, vocabulary):
    raw = np.array([(1 + math.log(bag[w])) * idf if bag[w] else 0.0 for w, idf in vocabulary.items()])
    size = np.linalg.norm(raw)
    return raw / size if size else raw


def test_op11_over_the_whole_table(spark):
    """Vocabulary, all similarities, the k nearest, votes and scores worked out again."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    learned = {i: y for i, y in truth.items() if i not in held}
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = spark.createDataFrame([(i, y, 0.0) for i, y in learned.items()], LABELS)
    model = toxicity.train(frame, rows, least_evidence=4.0)
    vocabulary = vocabulary_by_hand(docs, learned, 4.0, 2.0)
    assert sorted(map(hash_of, vocabulary)) == model.vocabulary.hashes.tolist() and len(vocabulary) > 10
    by_hash = dict(zip(model.vocabulary.hashes.tolist(), model.vocabulary.idf, strict=True))
    assert all(abs(by_hash[hash_of(w)] - idf) < 1e-12 for w, idf in vocabulary.items())
    examples = [(str(i), learned[i], vector(words_of(t), vocabulary)) for i, t in docs if i in learned]
    matrix = np.array([v for _, _, v in examples])
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        similar = matrix @ vector(words_of(t), vocabulary)
        want = np.sort(similar[similar > 1e-12])[::-1][: toxicity.NEIGHBOURS]
        evidence = got[i].evidence
        assert np.allclose([e.similarity for e in evidence], want, atol=1e-12) and len(evidence) == len(want)
        own = {e[0]: s for e, s in zip(examples, similar, strict=True)}
        assert all(abs(own[e.doc_id] - e.similarity) < 1e-12 and learned[int(e.doc_id)] == e.label for e in evidence)
        weight = np.array([e.similarity for e in evidence]) ** 2
        vote = (weight @ np.array([e.label for e in evidence], float) + model.share) / (weight.sum() + 1)
        p = min(max(vote, 1e-6), 1 - 1e-6)
        assert abs(got[i].score - 1 / (1 + math.exp(-model.slope * math.log(p / (1 - p)) - model.shift))) < 1e-9
    rows = QUERIES["op11_toxicity"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(got) and len(rows) == len(docs)
    assert all(r.held_out == (r.doc_id in held) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_blocks_passed_over_hold_no_nearer_example(seed):
    rng = np.random.default_rng(seed)
    words, examples = 60, []
    for i in range(400):
        some = np.sort(rng.choice(words, rng.integers(0, 8), replace=False, p=np.arange(1, 61) / 1830))
        weights = rng.random(len(some)) if seed % 2 else np.ones(len(some))
        examples.append((str(i), i % 2, some, weights / max(np.linalg.norm(weights), 1e-9)))
    index = toxicity.Index.build(examples, words)
    at = {known: i for i, known in enumerate(index.ids)}
    dense = np.zeros((400, words))
    for known, _, some, weights in examples:
        dense[at[known], some] = weights
    for known, _, some, weights in examples[:80]:
        q = np.zeros(words)
        q[some] = weights
        found, near = index.search(some, weights, 10, at[known])
        all_near = np.delete(dense @ q, at[known])
        want = np.sort(all_near[all_near > 0])[::-1][:10]
        assert np.allclose(near, want, atol=1e-12) and np.allclose(dense[found] @ q, near, atol=1e-12)
        assert at[known] not in found


def test_most_blocks_are_passed_over(monkeypatch):
    """One telling word a cluster: only the blocks of the query's own cluster are opened."""
    examples = [(str(i), 0, np.array([i // 64]), np.ones(1)) for i in range(6400)]
    index = toxicity.Index.build(examples, 100)
    found, near = index.search(np.array([7]), np.ones(1), 5)
    assert len(found) == 5 and (near == 1).all()
    assert ((np.ones(1) @ index.peaks[[7]]) > 0).sum() <= 2


def test_accuracy_on_rows_that_were_held_out(spark):
    path = SF_DIR.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op11_toxicity"](spark, path).collect()}
    labels = spark.read.parquet(f"{path}/labels.parquet").collect()
    pairs = [(got[r.doc_id].predicted, r.toxic) for r in labels if got[r.doc_id].held_out]
    caught = [p for p, y in pairs if y == 1]
    clean = [p for p, y in pairs if y == 0]
    assert np.mean(caught) > 0.7 and np.mean(clean) < 0.02


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    rows = [(i, "you idiot " + "nice " * (i % 3)) for i in range(20)] + [(i, "have a nice day") for i in range(20, 60)]
    odd = [(60, None), (61, ""), (62, "12 .,"), (None, "idiot"), (0, "you idiot"), (63, "plain " * 200_000 + "idiot")]
    docs = spark.createDataFrame(
        [(i, t, 9, "x", 1) for i, t in rows + odd], "doc_id long, text string, score int, evidence string, label int"
    )
    marks = [(i, int(i < 20), 0.0) for i in range(60)] + [(0, 0, 0.0), (None, 1, 0.0), (5, None, 0.0), (63, 2, 0.0)]
    model = toxicity.train(docs, spark.createDataFrame(marks, LABELS), least_evidence=5.0)
    got = [(r.doc_id, r.text, r.score, r.evidence) for r in toxicity.score(docs, model).collect()]
    assert len(got) == len(rows) + len(odd)
    for i, t, score, evidence in got:
        if t and "idiot" in t:
            assert score > 0.7 and len(evidence) == toxicity.NEIGHBOURS, i
        else:
            assert score < 0.5
        if i in (60, 61, 62):
            assert evidence == []
    assert toxicity.score(docs.limit(0), model).collect() == []
    for some, constant in (([], 0.5), ([(1, 1, 0.0)], 1.0), ([(1, 0, 0.0)], 0.0)):
        plain = toxicity.train(docs, spark.createDataFrame(some, LABELS))
        assert {r.score for r in toxicity.score(docs, plain).collect()} == {constant}
    same = spark.createDataFrame([(i, i % 2, 0.0) for i in range(60)], LABELS)
    assert len(toxicity.score(docs, toxicity.train(docs, same, least_evidence=1e9)).collect()) == len(got)
