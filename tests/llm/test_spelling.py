"""Near words against all pairs by definition, and the machine against small languages."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_join_archive_pipeline import SF_DIR
from tidelog.llm import spelling
from tidelog.llm.queries import QUERIES

UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def words_by_hand(rows, length=7, count=2):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= length and n >= count}


def variants_by_hand(words, ratio=10):
    """Words that share all but one letter have a deletion in common: compare only those."""
    cut = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            cut.setdefault(key, []).append(w)
    links = {w: set() for w in words}
    for some in cut.values():
        for a in some:
            links[a].update(b for b in some if b != a and b not in links[a] and near(a, b))
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(links[w]), form[w] and words[form[w]]))
    return out


@pytest.mark.parametrize("letters", ["abc", "aé", "x"])
def test_the_composed_machine_accepts_pairs_one_edit_apart_once(letters):
    random.seed(2)
    for _ in range(30):
        words = sorted(
            {
                (g, "".join(random.choice(letters) for _ in range(random.randint(0, 5))))
                for g in range(random.randint(1, 4))
                for _ in range(random.randint(1, 60))
            }
        )
        codes = np.frombuffer("".join(w for _, w in words).encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(w) for _, w in words])])
        group = np.unique([g for g, _ in words], return_inverse=True)[1]
        machine = spelling.Acceptor(group, codes, bounds)
        first, second = spelling.one_edit_pairs(machine)
        got = sorted(tuple(sorted(p)) for p in zip(first.tolist(), second.tolist(), strict=True))
        every = range(len(words))
        want = [
            (i, j) for i in every for j in every
            if i < j and words[i][0] == words[j][0] and near(words[i][1], words[j][1])
        ]
        assert got == want
        assert all(len(words[i][1]) >= len(words[j][1]) for i, j in zip(first, second, strict=True))


def test_states_with_the_same_words_ahead_are_one():
    words = ["bat", "bats", "cat", "cats", "rat", "rats"]
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    machine = spelling.Acceptor(np.zeros(6, np.int64), codes, np.cumsum([0, *map(len, words)]))
    assert len(machine.final) == 5 and machine.words[machine.initial[0]] == 6


@pytest.mark.parametrize("most", [20_000, 3])
def test_near_words_in_whole_and_in_split_groups(spark, most):
    random.seed(5)
    words = {"".join(random.choice("ab") for _ in range(random.randint(1, 9))) for _ in range(250)}
    # A hot half-word: most words begin, and many end, alike.
    words |= {"prefixed" + "".join(random.choice("abcd") for _ in range(random.randint(0, 4))) for _ in range(150)}
    words |= {"".join(random.choice("xyz") for _ in range(random.randint(1, 3))) + "suffix" for _ in range(50)}
    frame = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long").repartition(5)
    rows = spelling.near_words(frame, most).collect()
    got = [(r.word, r.near, r.near_n) for r in rows]
    want = {(a, b, len(b)) for a in words for b in words if a != b and near(a, b)}
    assert len(got) == len(want) and set(got) == want


def test_groups_are_split_down_to_single_letters(spark):
    words = [("a" * 12 + chr(97 + i) + chr(97 + j), 1) for i in range(20) for j in range(20)]
    rows = spelling.groups(spark.createDataFrame(words, "word string, n long"), 100)
    sizes = rows.groupBy("key", "path").count().collect()
    # 2**4 >= 14: after four halvings at most one letter is left, two in the longer words.
    assert all(r["count"] <= 100 or len(r.path) == 4 for r in sizes)
    assert max(r["count"] for r in sizes) <= 20 * 20


def test_op13_over_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = variants_by_hand(words_by_hand(rows))
    got = [tuple(r) for r in QUERIES["op13_spelling_variants"](spark, SF_DIR).collect()]
    assert len(got) == len(want) > 1000 and set(got) == want


def test_chains_ties_nulls_long_texts_and_clashing_names(spark):
    rows = [
        (None, "walking " * 3 + "Walkinh walkinh"), (2, None), (3, ""), (4, "12 .. 中"),
        (5, "walkinq " * 40 + "walkinG " * 400), (5, "walkinq " * 40), (6, "x" * 50_000 + " " + "x" * 50_000),
        (7, "y" + "x" * 49_999 + " " + "y" + "x" * 49_999), (8, "École×÷ab " * 2),
    ]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, word string")
    want = variants_by_hand(words_by_hand(rows))
    got = [tuple(r) for r in spelling.spelling_variants(docs).collect()]
    assert len(got) == len(want) and set(got) == want
    assert spelling.spelling_variants(docs.limit(0)).collect() == []


def test_links_are_followed_to_their_end(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [("a", "w4"), ("b", "c")]
    frame = spark.createDataFrame(links, "word string, root string")
    got = {r.word: r.root for r in spelling._follow(frame).collect()}
    assert got == {w: "c" if w == "b" else "w11" for w, _ in links}
