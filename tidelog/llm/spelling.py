"""Spelling variants: words one edit apart, found by composing finite-state machines.

The words of a group are the language of a minimised acceptor.  Composing it with a transducer that
makes exactly one edit, and with the acceptor again, gives a machine whose accepted pairs are the
near words; it is walked breadth first, all groups of a block at once.

Groups are the partitions of the composed machine's initial states.  Two words of which the
shorter has m letters and that are one edit apart agree on the first m // 2 letters (the edit lies
behind them) or on the last m - m // 2 (it lies before).  So each word is in a group by its first
and by its last half, as a word of m letters and as one of m + 1, and in each group only what is left
of the words is composed.  A group beyond a size is split again by halves of what is left, which
ends at single letters; no group, hub or hot half-word stays whole, and no pair is left out.

Words are maximal runs of letters A-Z, a-z and U+00C0 to U+00FF in whole texts, with A-Z in lower
case.  With h the crc32 of `<id>:<run>` (a null id is empty), a run loses its letter number
h % length where 31 divides h.  Null and empty texts have no words, rows that repeat count again,
an empty table gives no rows, other columns take no part.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.sources.scratch import durable

#: A group with more rows is split once more; what is composed at once has about as many rows.
GROUP_ROWS = 20_000
_SALTS = 16
_GROUPS = "key long, word string, n long, m int, path string"


def count_words(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """word, n: all words of at least `least_length` letters that occur at least `least_count` times."""
    # A shorter run cannot become a word; the possessive count takes maximal runs only.
    pattern = f"[A-Za-z\\u00C0-\\u00FF]{{{max(least_length, 1)},}}+"
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(pattern), 0)).alias("run"),
    )
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    small = F.when(F.rlike("run", F.lit("[A-Z]")), F.translate("run", upper, upper.lower())).otherwise(F.col("run"))
    hashed = runs.select(small.alias("run"), "id").select(
        "run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h")
    )
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_length))


# --- groups: the initial states of the composed machine ----------------------------------------


def _left(word: str, m: int, path: str) -> tuple[int, int, int]:
    """Where what is left of a word begins and ends, and its length in a word of m letters."""
    start, end, t = 0, len(word), m
    for side in path:
        if side == "P":
            start, t = start + t // 2, t - t // 2
        else:
            end, t = end - (t - t // 2), t // 2
    return start, end, t


def _halves(rows: DataFrame, left: Column, t: Column) -> DataFrame:
    """Each row in its group by the first and by the last half of what is left of its word.

    `left` has t letters, or t + 1 in the longer words of the group.
    """
    half = F.floor(t / 2).cast("int")
    first = F.substring(left, F.lit(1), half)
    last = F.substring(left, F.length(left) - (t - half) + 1, F.length(left))
    sides = F.array(
        F.struct(F.lit("P").alias("side"), first.alias("part")), F.struct(F.lit("S").alias("side"), last.alias("part"))
    )
    split = rows.withColumn("__of", F.explode(sides))
    key = F.xxhash64("key", "m", "path", "__of.side", "__of.part")
    return split.select(
        key.alias("key"), "word", "n", "m", F.concat("path", "__of.side").alias("path")
    )


def _first_groups(words: DataFrame) -> DataFrame:
    as_either = words.withColumn("m", F.length("word"))
    as_longer = words.withColumn("m", F.length("word") - 1)
    rows = as_either.union(as_longer).select(
        F.lit(0).cast("long").alias("key"), "word", "n", "m", F.lit("").alias("path")
    )
    return _halves(rows, F.col("word"), F.col("m"))


def _split(rows: DataFrame) -> DataFrame:
    """The rows of groups that are too large, each by halves of what is left."""
    # The path folds to begin, end and length as in _left.
    start = F.struct(
        F.lit(1).alias("start"), F.length("word").alias("size"), F.col("m").alias("t")
    )

    def step(state: Column, side: Column) -> Column:
        half = F.floor(state["t"] / 2).cast("int")
        rest = state["t"] - half
        front = side == "P"
        return F.struct(
            F.when(front, state["start"] + half).otherwise(state["start"]).alias("start"),
            (state["size"] - F.when(front, half).otherwise(rest)).alias("size"),
            F.when(front, rest).otherwise(half).alias("t"),
        )

    letters = F.filter(F.split("path", ""), lambda c: c != "")
    placed = rows.withColumn("__left", F.aggregate(letters, start, step))
    tail = F.substring(F.col("word"), F.col("__left.start"), F.col("__left.size"))
    return _halves(placed, tail, F.col("__left.t"))


def _splittable() -> Column:
    """True while more than one letter is left: after that the alphabet bounds a group."""
    return F.length("path") < F.ceil(F.log2(F.col("m")))


def groups(words: DataFrame, most: int = GROUP_ROWS) -> DataFrame:
    """Rows key, word, n, m, path: in which groups each word is; no group beyond `most` rows.

    But for groups with at most one letter left, which have no more rows than pairs of letters.
    """
    rows = _first_groups(words)
    done = None
    while True:
        sizes = rows.where(_splittable()).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
        # At most one key per `most` rows; written out, so that its size is known to the join.
        hot = durable(sizes.where(F.col("rows") > most).select("key"))
        if hot.isEmpty():
            return rows if done is None else done.union(rows)
        small = rows.join(hot, "key", "left_anti")
        done = small if done is None else done.union(small)
        rows = durable(_split(rows.join(hot, "key", "left_semi")))


# --- the machines -------------------------------------------------------------------------------


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices start, start + 1, ... of each span, and the number of the span each is in."""
    of = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return starts[of] + np.arange(len(of)) - first[of], of


class Acceptor:
    """Minimised deterministic acceptor of the words of many groups, with one initial state each.

    Words come sorted by group and letters, without repeats, and are numbered so.  A transition's
    offset is the number of words of its state that come before those it leads to: the offsets along
    a path add up to the word's number.
    """

    def __init__(self, group: np.ndarray, codes: np.ndarray, bounds: np.ndarray):
        n_groups = int(group[-1]) + 1 if len(group) else 0
        lengths = np.diff(bounds)
        # The tree of prefixes, level by level.
        node, word = group.astype(np.int64), np.arange(len(group))
        total = n_groups
        ends = np.full(len(group), -1, np.int64)
        parents, symbols, levels = [], [], [(0, n_groups)]
        depth = 0
        while len(word):
            over = lengths[word] == depth
            ends[word[over]] = node[over]
            word, node = word[~over], node[~over]
            if not len(word):
                break
            symbol = codes[bounds[word] + depth].astype(np.int64)
            edge, inverse = np.unique(node << 21 | symbol, return_inverse=True)
            parents.append(edge >> 21)
            symbols.append(edge & (1 << 21) - 1)
            node = total + inverse
            levels.append((total, total + len(edge)))
            total += len(edge)
            depth += 1
        parent = np.concatenate([np.full(n_groups, -1), *parents]).astype(np.int64)
        symbol = np.concatenate([np.zeros(n_groups, np.int64), *symbols])
        final = np.zeros(total, bool)
        final[ends] = True
        self._minimise(parent, symbol, final, levels, n_groups)
        # A group's words are numbered from its first one on.
        self.base = np.searchsorted(group, np.arange(n_groups))

    def _minimise(self, parent, symbol, final, levels, n_groups) -> None:
        """States with the same words ahead become one; the lowest come first."""
        total = len(parent)
        height = np.zeros(total, np.int64)
        for lo, hi in reversed(levels[1:]):
            np.maximum.at(height, parent[lo:hi], height[lo:hi] + 1)
        # Nodes are in order of parent and symbol within each level: so are a node's children.
        first = np.full(total, -1, np.int64)
        degree = np.bincount(parent[n_groups:], minlength=total)
        np.minimum.at(first_child := np.full(total, total), parent[n_groups:], np.arange(n_groups, total))
        first = np.where(degree > 0, first_child, 0)
        state = np.full(total, -1, np.int64)
        out_degree, out_symbol, out_to, finals = [], [], [], []
        made = 0
        order = np.lexsort((degree, height))
        cuts = np.flatnonzero(np.diff(height[order]) | np.diff(degree[order])) + 1
        for nodes in np.split(order, cuts):
            if not len(nodes):
                continue
            k = int(degree[nodes[0]])
            child = first[nodes][:, None] + np.arange(k)
            row = np.concatenate([final[nodes, None], symbol[child], state[child]], axis=1)
            kinds, inverse = np.unique(row, axis=0, return_inverse=True)
            state[nodes] = made + inverse.reshape(-1)
            made += len(kinds)
            finals.append(kinds[:, 0].astype(bool))
            out_degree.append(np.full(len(kinds), k))
            out_symbol.append(kinds[:, 1 : 1 + k].reshape(-1))
            out_to.append(kinds[:, 1 + k :].reshape(-1))
        join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)
        self.final = join(finals).astype(bool)
        self.degree, self.symbol, self.to = join(out_degree), join(out_symbol), join(out_to)
        self.start = np.cumsum(self.degree) - self.degree
        self.initial = state[:n_groups]
        # Words ahead of each state: targets are lower, so in rising order of height.
        self.words = self.final.astype(np.int64)
        self.offset = np.zeros(len(self.to), np.int64)
        at = 0
        for kinds in out_degree:
            for_these = np.arange(at, at + len(kinds))
            k = int(kinds[0])
            if k:
                edges = self.start[for_these][:, None] + np.arange(k)
                ahead = self.words[self.to[edges]]
                before = np.cumsum(ahead, axis=1) - ahead + self.final[for_these, None]
                self.offset[edges] = before
                self.words[for_these] += ahead.sum(axis=1)
            at += len(kinds)
        self._edge = np.repeat(np.arange(len(self.degree)), self.degree) << 21 | self.symbol

    def edges(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All transitions of the states, and the place of the state each is of."""
        return _spread(self.start[states], self.degree[states])

    def find(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transition of each state by each symbol, and whether there is one."""
        wanted = states << 21 | symbols
        place = np.minimum(np.searchsorted(self._edge, wanted), max(len(self._edge) - 1, 0))
        return place, self._edge[place] == wanted if len(self._edge) else np.zeros(len(states), bool)


def one_edit_pairs(machine: Acceptor) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all pairs of words of one group that are exactly one edit apart, each pair once.

    The second word is never the longer one.  Composed states are (first, edit, second): before the
    edit both words are on one path; a replacement takes two symbols of a state, a deletion a symbol
    of the first word alone.  To take each pair once, an edit comes as late as it can: after a deletion
    the second word must not go on with the deleted symbol.
    """
    one, number = machine.initial.copy(), machine.base.copy()
    nothing = np.zeros(0, np.int64)
    after = (nothing,) * 5  # first state and number, second state and number, forbidden symbol
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(one) or len(after[0]):
        made = [_matched(machine, after)]
        if len(one):
            edge, of = machine.edges(one)
            to, at = machine.to[edge], number[of] + machine.offset[edge]
            # Replacements: this transition and each later one of the same state.
            later = np.repeat(np.cumsum(machine.degree[one]), machine.degree[one]) - np.arange(len(edge)) - 1
            second, first = _spread(np.arange(len(edge)) + 1, later)
            made.append((to[first], at[first], to[second], at[second], np.full(len(first), -1)))
            made.append((to, at, one[of], number[of], machine.symbol[edge]))
            one, number = to, at
        after = tuple(np.concatenate(x) for x in zip(*made, strict=True))
        first, first_at, second, second_at, forbidden = after
        # One state on both sides: all words ahead pair up, without a walk.
        same = (first == second) & (forbidden < 0)
        many, of = _spread(np.zeros(int(same.sum()), np.int64), machine.words[first[same]])
        found.append((first_at[same][of] + many, second_at[same][of] + many))
        both = machine.final[first] & machine.final[second] & ~same
        found.append((first_at[both], second_at[both]))
        after = tuple(x[~same] for x in after)
    return tuple(np.concatenate([x[i] for x in found] or [nothing]) for i in (0, 1))


def _matched(machine: Acceptor, after: tuple) -> tuple:
    """Composed states after the edit, one common symbol further."""
    first, first_at, second, second_at, forbidden = after
    # Walk the side with fewer transitions, look up the other.
    swap = machine.degree[second] < machine.degree[first]
    walk, other = np.where(swap, second, first), np.where(swap, first, second)
    edge, of = machine.edges(walk)
    there, known = machine.find(other[of], machine.symbol[edge])
    known &= machine.symbol[edge] != forbidden[of]
    edge, there, of = edge[known], there[known], of[known]
    a, b = np.where(swap[of], there, edge), np.where(swap[of], edge, there)
    return (
        machine.to[a],
        first_at[of] + machine.offset[a],
        machine.to[b],
        second_at[of] + machine.offset[b],
        np.full(len(of), -1),
    )


def _owned(longer: str, shorter: str, path: str) -> bool:
    """False if the pair is in a group by its first halves, too, at some step of the path."""
    m = len(shorter)
    for i, side in enumerate(path):
        if side == "S":
            start, _, t = _left(shorter, m, path[:i])
            if longer[start : start + t // 2] == shorter[start : start + t // 2]:
                return False
    return True


def _pairs_of(table: pa.Table) -> pa.RecordBatch | None:
    """Near words in whole groups, both ways round: word, near, near_n."""
    order = np.argsort(table.column("key").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    key = table.column("key").to_numpy()
    _, inverse, many = np.unique(key, return_inverse=True, return_counts=True)
    table = table.filter(pa.array(many[inverse] > 1))
    if not table.num_rows:
        return None
    key, m = table.column("key").to_numpy(), table.column("m").to_pylist()
    words, paths = table.column("word").to_pylist(), table.column("path").to_pylist()
    n = table.column("n").to_numpy()
    group = np.unique(key, return_inverse=True)[1]
    left = [w[slice(*_left(w, k, p)[:2])] for w, k, p in zip(words, m, paths, strict=True)]
    order = sorted(range(len(left)), key=lambda i: (group[i], left[i]))
    codes = np.frombuffer("".join(left[i] for i in order).encode("utf-32-le"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(left[i]) for i in order])])
    a, b = one_edit_pairs(Acceptor(group[order], codes, bounds))
    place = np.array(order)
    pairs = []
    for i, j in zip(place[a].tolist(), place[b].tolist(), strict=True):
        # Two words of m + 1 letters meet in another group.
        if len(words[j]) == m[j] and (len(words[i]) == m[j] or _owned(words[i], words[j], paths[j])):
            pairs += [(i, j), (j, i)]
    if not pairs:
        return None
    first, second = np.array(pairs).T
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in first]), pa.array([words[j] for j in second]), pa.array(n[second])],
        names=["word", "near", "near_n"],
    )


def near_words(words: DataFrame, most: int = GROUP_ROWS) -> DataFrame:
    """word, near, near_n: all ordered pairs of distinct words exactly one edit apart, once each.

    `words`: word, n, without repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                table = pa.Table.from_batches(held).combine_chunks()
                last = table.column("key")[table.num_rows - 1]
                whole = int(np.searchsorted(table.column("key").to_numpy(), last.as_py()))
                found = _pairs_of(table.slice(0, whole)) if whole else None
                if found is not None:
                    yield found
                rest = table.slice(whole)
                held, rows = rest.to_batches(), rest.num_rows
        if held:
            found = _pairs_of(pa.Table.from_batches(held).combine_chunks())
            if found is not None:
                yield found

    dealt = groups(words, most).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "word string, near string, near_n long")


def spelling_variants(
    docs: DataFrame,
    ratio: int = 10,
    least_length: int = 7,
    least_count: int = 2,
    id_col: str = "doc_id",
    text: str = "text",
    most: int = GROUP_ROWS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    The form is the near word with the greatest n (the smallest such), if its n is at least
    `ratio` times the word's; the root is the last of the forms that follow from a word.
    """
    words = durable(count_words(docs, least_length, least_count, id_col, text))
    pairs = near_words(words, most)
    both = words.select(
        "word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")
    ).union(pairs.select("word", F.lit(None).cast("long"), "near", "near_n"))
    # A hub's near words are counted on the map side first.
    ranked = F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))
    summed = both.groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), F.min(ranked).alias("best")
    )
    taken = -F.col("best.less") >= ratio * F.col("n")
    formed = durable(
        summed.select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            "n_near",
            F.when(taken, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _follow(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _follow(links: DataFrame) -> DataFrame:
    """word, root: each word's link followed to the end, twice as far each time.

    n grows along the links, so there is no circle.  Many words may share a root: they meet what
    follows it over salted keys.
    """
    links = durable(links)
    while True:
        ends = links.select("root").distinct()
        onward = durable(
            ends.join(links.select(F.col("word").alias("root"), F.col("root").alias("__next")), "root")
        )
        if onward.isEmpty():
            return links
        salted = onward.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        own = links.withColumn("__salt", F.pmod(F.xxhash64("word"), F.lit(_SALTS)).cast("int"))
        links = durable(
            # Merged, not broadcast: what is copied to every salt is not measured beforehand.
            own.join(salted.hint("merge"), ["root", "__salt"], "left").select(
                "word", F.coalesce("__next", "root").alias("root")
            )
        )
