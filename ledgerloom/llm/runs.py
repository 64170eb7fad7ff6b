"""Periodic runs of words in each text, found in its grammar.

Re-Pair replaces repeated pairs of word ids, text by text, until no pair occurs twice. Pairs that are more frequent than
all pairs they overlap are replaced in one round, for all texts of a batch at once; a pair that occurs once stays a
boundary for good, and the symbols between two such boundaries leave the work. What is left of a text is a row of
symbols, and a balanced tree over it completes the grammar: its inner nodes are used once, and a frequent word's
occurrences are met once on each level.

Each nonterminal's boundary is looked at once, at one place of its derivation. A run over a boundary has words equal to
those one period further, along a stretch that holds three words at the boundary (or, if it lies in the last period, at
the place one period before). So the other occurrences of those three words within the nonterminal give all periods that
are possible, and how far each holds comes from prefix hashes. The runs are then translated to all places where the
nonterminal is derived, and of those with one period the maximal intervals stay. Hashes only ever make a stretch too long,
so each run is verified by its words, and the batch is done again with another base where one fails.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import map_texts

PRIME = (1 << 31) - 1
#: Pairs of places that are compared together.
COMPARED = 1 << 21
#: Texts of one pass hold about so many bytes; a longer text is a pass of its own.
PASS_BYTES = 1 << 20


def spans(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of ``sizes``: of each member the number of its group, and its place there."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def repair(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grammar of each text: ``words`` are ids that two texts never share, ``bounds`` where the texts begin and end.

    Returns the nonterminals' derivations as rows (rule, begin, middle, end), whether a boundary stands before a word
    that no nonterminal covers, and whether a word and the next one are a pair that occurs again.
    """
    n = len(words)
    opens = np.ones(n, bool)
    opens[bounds[:-1][bounds[:-1] < n]] = False  # a text's first word has no boundary before it
    symbol, begin, end = words.astype(np.int64), np.arange(n), np.arange(1, n + 1)
    linked = np.ones(n, bool)
    linked[bounds[1:][bounds[1:] > 0] - 1] = False
    rules, again, next_symbol, next_rule = [], None, int(words.max()) + 1 if n else 0, 0
    while True:
        at = np.flatnonzero(linked)
        _, kind, count = np.unique(symbol[at] * (1 << 32) + symbol[at + 1 if len(at) else at], return_inverse=True, return_counts=True)
        linked[at[count[kind] == 1]] = False
        if again is None:
            again = linked.copy()
        if not linked.any():
            break
        weight = np.full(len(linked) + 2, -1)
        weight[at + 1] = np.where(count[kind] > 1, count[kind] * len(count) + kind, -1)
        here = weight[1:-1]
        best = np.flatnonzero((here >= 0) & (here >= weight[:-2]) & (here >= weight[2:]))
        # of overlapping pairs of one word, every second one
        head = np.diff(best, prepend=-2) != 1
        chain = np.maximum.accumulate(np.where(head, np.arange(len(best)), 0))
        best = best[(np.arange(len(best)) - chain) % 2 == 0]
        _, rule = np.unique(here[best], return_inverse=True)
        rules.append(np.stack([rule + next_rule, begin[best], begin[best + 1], end[best + 1]]))
        opens[begin[best + 1]] = False
        symbol[best] = rule + next_symbol
        end[best], linked[best] = end[best + 1], linked[best + 1]
        next_symbol, next_rule = next_symbol + rule.max() + 1, next_rule + rule.max() + 1
        keep = linked.copy()
        keep[1:] |= linked[:-1]
        keep[best + 1] = False
        keep[best] |= linked[best]
        symbol, begin, end, linked = symbol[keep], begin[keep], end[keep], linked[keep]
    derived = np.concatenate(rules, axis=1) if rules else np.zeros((4, 0), np.int64)
    return derived, opens, again


class Prefixes:
    """Hashes of all stretches of a row of ids."""

    def __init__(self, words: np.ndarray, seed: int) -> None:
        draw = np.random.default_rng(seed)
        value = draw.integers(1, PRIME, int(words.max()) + 1 if len(words) else 1)[words]
        self.power = np.ones(1, np.int64)
        step = int(draw.integers(1 << 20, PRIME))
        while len(self.power) <= len(words):
            self.power = np.concatenate([self.power, self.power * step % PRIME])
            step = step * step % PRIME
        self.sums = np.concatenate([[0], np.cumsum(value * self.power[: len(words)] % PRIME) % PRIME])

    def equal(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from x on are those from y on, for y after x."""
        s = self.sums
        return ((s[x + n] - s[x]) * self.power[y - x] - (s[y + n] - s[y])) % PRIME == 0

    def reach(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from x and y on, or before them, agree, up to ``most``."""
        low, high = np.zeros(len(x), np.int64), most.astype(np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            half = (low[open_] + high[open_] + 1) // 2
            shift = half if back else 0
            same = self.equal(x[open_] - shift, y[open_] - shift, half)
            low[open_] = np.where(same, half, low[open_])
            high[open_] = np.where(same, high[open_], half - 1)
        return low


def smallest(node: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> list[np.ndarray]:
    """Of equal stretches of a node the smallest period: a larger one is a multiple of it."""
    order = np.lexsort((period, end, begin, node))
    rows = [x[order] for x in (node, begin, end, period)]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0) | (np.diff(rows[2]) != 0)
    return [x[new] for x in rows]


def over_boundaries(
    nodes: np.ndarray, words: np.ndarray, bounds: np.ndarray, again: np.ndarray, hashes: Prefixes, least: int
) -> list[np.ndarray]:
    """Runs inside nodes (begin, middle, end) that lie over the middle: node, begin, end and period of each."""
    n = len(words)
    gram = max(1, -(-(-(-least // 2)) // 2))  # a stretch of half the length has so many on one side of the boundary
    fits = np.ones(n, bool)
    for k in range(gram - 1):  # words that occur again together; this never reaches over the end of a text
        fits[: n - k] &= again[k:]
        fits[n - k:] = False
    at = np.flatnonzero(fits)
    mixed = np.zeros(len(at), np.uint64)
    for k in range(gram):
        mixed = (mixed ^ words[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    kind = np.cumsum(np.diff(mixed[order], prepend=mixed[order[:1]]) != 0)
    kind_of = np.full(n, -1)
    kind_of[at[order]] = kind
    places = at[order]
    sorted_ = kind * (n + 1) + places
    begin, middle, end = nodes
    found = []
    for shift in (0, gram):  # the words from the boundary on, and those before it
        text_begin = bounds[np.searchsorted(bounds, middle, side="right") - 1]
        anchor = np.where(middle - shift >= text_begin, middle - shift, n - 1)
        own = np.where((middle - shift >= text_begin) & (anchor < n), kind_of[np.minimum(anchor, n - 1)], -1)
        has = np.flatnonzero(own >= 0)
        low = np.searchsorted(sorted_, own[has] * (n + 1) + np.maximum(begin[has] - shift, 0))
        high = np.searchsorted(sorted_, own[has] * (n + 1) + end[has] - shift)
        sizes = np.maximum(high - low, 0)
        # a node at a time may have many places, so nodes are taken together up to a number of them
        total = np.cumsum(sizes)
        first = 0
        while first < len(has):
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + COMPARED)))
            of, step = spans(sizes[first:last])
            node = has[first:last][of]
            other = places[low[first:last][of] + step] + shift
            first = last
            x, period = np.minimum(other, middle[node]), np.abs(other - middle[node])
            some = (period > 0) & (2 * period <= end[node] - begin[node])
            node, x, period = node[some], x[some], period[some]
            ahead = hashes.reach(x, x + period, end[node] - x - period)
            behind = hashes.reach(x, x + period, x - begin[node], back=True)
            long_ = ahead + behind >= np.maximum(period, least - period)
            node, x, period, ahead, behind = (v[long_] for v in (node, x, period, ahead, behind))
            found.append(smallest(node, x - behind, x + ahead + period, period))
    if not found:
        return [np.zeros(0, np.int64)] * 4
    return smallest(*(np.concatenate(x) for x in zip(*found, strict=True)))


def runs_of(words: np.ndarray, bounds: np.ndarray, least: int = 12) -> np.ndarray:
    """All runs as columns (begin, end, period), by begin and then period, of texts whose ids are never shared."""
    if not len(words):
        return np.zeros((3, 0), np.int64)
    derived, opens, again = repair(words, bounds)
    # nonterminals, each at the first place where it is derived
    by_rule = np.argsort(derived[0], kind="stable")
    derived = derived[:, by_rule]
    _, first, count = np.unique(derived[0], return_index=True, return_counts=True)
    rule_nodes = derived[1:, first]
    # the tree over what is left: symbol j of a text joins as many symbols on either side as its lowest bit says
    starts = np.flatnonzero(opens)
    text = np.searchsorted(bounds, starts, side="right") - 1
    before = np.searchsorted(starts, bounds)
    j = np.arange(len(starts)) - before[text] + 1
    low = j & -j
    left, right = j - low, j + low
    places = np.concatenate([starts, [len(words)]])
    tree_begin = np.where(left == 0, bounds[text], places[np.maximum(before[text] + left - 1, 0)])
    past = right > before[text + 1] - before[text]
    tree_end = np.where(past, bounds[text + 1], places[np.where(past, 0, before[text] + right - 1)])
    nodes = np.concatenate([rule_nodes, np.stack([tree_begin, starts, tree_end])], axis=1)
    large = np.flatnonzero(nodes[2] - nodes[0] >= least)
    seed = 0
    while True:
        node, begin, end, period = over_boundaries(nodes[:, large], words, bounds, again, Prefixes(words, seed), least)
        node = large[node]
        is_rule = node < len(first)
        # to all places where the nonterminal is derived
        rule = node[is_rule]
        of, step = spans(count[rule])
        moved = derived[1, first[rule][of] + step] - derived[1, first[rule][of]]
        begin = np.concatenate([begin[~is_rule], begin[is_rule][of] + moved])
        end = np.concatenate([end[~is_rule], end[is_rule][of] + moved])
        period = np.concatenate([period[~is_rule], period[is_rule][of]])
        # of one period, those that no other one holds
        order = np.lexsort((-end, begin, period))
        begin, end, period = begin[order], end[order], period[order]
        reached = np.maximum.accumulate(period * (len(words) + 1) + end)
        new = np.diff(reached, prepend=-1) > 0
        _, begin, end, period = smallest(np.zeros(int(new.sum()), np.int64), begin[new], end[new], period[new])
        if holds(words, begin, end, period):
            order = np.lexsort((period, begin))
            return np.stack([begin[order], end[order], period[order]])
        seed += 1


def holds(words: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> bool:
    """Whether the words of each run equal those a period further."""
    sizes = end - begin - period
    total = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + COMPARED)))
        of, step = spans(sizes[first:last])
        at = begin[first:last][of] + step
        if (words[at] != words[at + period[first:last][of]]).any():
            return False
        first = last
    return True


def find(texts: list[str], least: int) -> tuple[pa.Array, list[str]]:
    """The runs of each text, and each text without what a run repeats."""
    lists = [t.encode().split() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    flat = [w for x in lists for w in x]
    codes = pa.array(flat, pa.binary()).dictionary_encode()
    ids = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(lists)), np.diff(bounds))
    words = np.unique(text * (len(codes.dictionary) + 1) + ids, return_inverse=True)[1]
    begin, end, period = runs_of(words, bounds, least)
    covered = np.zeros(len(flat) + 1, np.int64)
    np.add.at(covered, begin + period, 1)
    np.add.at(covered, end, -1)
    kept = np.cumsum(covered)[:-1] == 0
    of = np.searchsorted(bounds, begin, side="right") - 1
    each = pa.StructArray.from_arrays(
        [pa.array(begin - bounds[of]), pa.array(end - begin), pa.array(period)], names=["start", "length", "period"])
    offsets = np.searchsorted(begin, bounds)
    runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each)
    collapsed = []
    for x, a, b in zip(lists, bounds[:-1], bounds[1:], strict=True):
        if not kept[a:b].all():
            x = [x[i] for i in np.flatnonzero(kept[a:b])]
        collapsed.append(b" ".join(x).decode())
    return runs, collapsed


def with_runs(docs: DataFrame, text_col: str = "text", runs: str = "runs", collapsed: str = "collapsed", least: int = 12) -> DataFrame:
    """``docs`` with all runs of words of each whole text, and the text without their repeats.

    A run is a stretch of words with smallest period q, of at least ``least`` words and two periods, that no
    neighbouring word extends; words are cut at ASCII white space. ``runs`` is an array of start, length and period in
    words, by start and then period. ``collapsed`` joins by single spaces the words that no run contains after its first
    period. A null or blank text has no run and an empty rest. Every row is judged by itself, so repeated ones agree;
    other columns are passed on, those of the two names are replaced.
    """
    kinds = {runs: "array<struct<start:long,length:long,period:long>>", collapsed: "string"}
    return map_texts(docs, text_col, kinds, lambda texts: list(find(texts, least)), PASS_BYTES)
