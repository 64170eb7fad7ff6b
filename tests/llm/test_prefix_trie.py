"""The prefix trie against one built in memory."""

import hashlib
import random
from collections import defaultdict

import pytest

from ledgerloom.llm import prefix_trie
from ledgerloom.operators.windows import HOT_ROWS_SETTING

KINDS = "conv_id long, turn long, role string, text string, c string, depth string"


def brute(talks):
    """Nodes of {conversation: [(role, text), ...]}."""
    members, children = defaultdict(list), defaultdict(list)
    for c in sorted(talks):
        for d in range(len(talks[c]) + 1):
            members[tuple(talks[c][:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    out = {}
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        ends = ",".join(str(c) for c in members[k] if len(talks[c]) == len(k))
        out[k] = (
            min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(children[k]),
            sum(out[x][5] for x in children[k]) or 1, own + sum(out[x][6] for x in children[k]), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def found(spark, rows, ids=None, **more):
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], KINDS).repartition(5)
    made = prefix_trie.prefix_trie(turns, ids, **more)
    assert made.columns == prefix_trie.NODE
    return sorted((tuple(r) for r in made.collect()), key=str)


def talks_of(rows):
    out = defaultdict(list)
    for c, _, r, x in sorted(rows, key=lambda r: (r[0], r[1])):
        out[c].append((r or "", x or ""))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for c in range(60):
        n = rng.choice([1, 2, 3, 5, 9])
        out += [(c * 3 - 20, t, rng.choice(["user", "assistant"]), rng.choice(["a", "é", "a longer one"])) for t in range(n)]
    out += [(500 + c, t, "user", f"shared {t}") for c in range(30) for t in range(6)]  # copies
    out += [(600 + c, t, "user", f"shared {t}" if t < 4 else f"own {c} {t}") for c in range(10) for t in range(40)]
    return out


def test_nodes_agree_with_brute_force(spark, rows):
    assert found(spark, rows) == brute(talks_of(rows))


def test_a_sketch_too_small_only_costs_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "MOST_CELLS", 1 << 10)
    monkeypatch.setattr(prefix_trie, "BLOCK", 1 << 8)
    monkeypatch.setattr(prefix_trie, "FAN_IN", 2)
    assert found(spark, rows) == brute(talks_of(rows))


def test_hot_conversations_go_through_chunks(spark, rows):
    spark.conf.set(HOT_ROWS_SETTING, "20")
    try:
        assert found(spark, rows) == brute(talks_of(rows))
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)


def test_conversations_without_turns_end_at_the_root(spark):
    rows = [(5, 0, "user", "x"), (9, 0, "user", "x")]
    ids = spark.createDataFrame([(9,), (3,), (5,), (None,), (3,), (12,)], "k long")
    expected = brute({3: [], 5: [("user", "x")], 9: [("user", "x")], 12: []})
    assert found(spark, rows, ids) == expected
    assert found(spark, [], ids.filter("k = 3")) == brute({3: []})


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, None, "n"), (1, 2, "user", None), (2, None, "", "n"), (2, 0, "user", ""),
        (3, 7, "user", "twice"), (3, 7, "user", "twice"), (4, 1, "user", "twice"),
    ]
    talks = {1: [("", "n"), ("user", "")], 2: [("", "n"), ("user", "")], 3: [("user", "twice")] * 2, 4: [("user", "twice")]}
    assert found(spark, rows) == brute(talks)
    assert found(spark, []) == []
    # turns of one number are taken in the same order in each conversation
    tied = [(c, 0, "user", x) for c in (1, 2, 3) for x in random.Random(c).sample(["p", "q", "r"], 3)]
    assert len(found(spark, tied)) == 4


def test_length_and_place_are_part_of_a_prefix(spark):
    rows = [(1, 0, "us", "era"), (2, 0, "user", "a"), (3, 0, "a", "x"), (3, 1, "b", "y"), (4, 0, "b", "y"), (4, 1, "a", "x")]
    assert found(spark, rows) == brute(talks_of(rows))


def test_long_conversation_and_long_text(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2) for t in range(1500)] + [(3, 0, "user", "y" * 500_000)]
    assert found(spark, rows) == brute(talks_of(rows))


def test_only_prefixes_that_may_be_shared_are_grouped(spark, rows):
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], KINDS)
    seen = prefix_trie.screened(prefix_trie.prefixes(turns, "conv_id", ["turn"], "role", "text"))
    alone = seen.filter("NOT maybe").join(seen.groupBy("key").count().filter("count > 1"), "key", "left_semi")
    assert alone.count() == 0
    singles = seen.groupBy("key").count().filter("count = 1").count()
    assert seen.filter("NOT maybe").count() > 0.9 * singles
