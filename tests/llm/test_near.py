import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpora import prose

from ledgerloom.llm import near_dedup
from ledgerloom.llm.components import components


def bag(text):
    words = (text or "").encode().split()
    if not words:
        return Counter()
    return Counter([tuple(words)] if len(words) < 5 else [tuple(words[i:i + 5]) for i in range(len(words) - 4)])


def weighted(a, b):
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def classes(rows, least=0.8):
    """Brute force: links between all pairs, classes by union."""
    bags = [bag(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if bags[i] and bags[j] and weighted(bags[i], bags[j]) >= least:
            up[root(j)] = root(i)
    out = defaultdict(list)
    for i in range(len(rows)):
        out[root(i)].append(rows[i][0])
    return sorted(sorted(x) for x in out.values())


def edited(text, rng, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def table(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(25):
        base = prose(1000 * seed + k, rng.choice([3, 8, 30, 100, 250]))
        rows.append(base)
        rows += [edited(base, rng, rng.randrange(0, 1 + len(base.split()) // 20)) for _ in range(rng.choice([0, 0, 1, 2, 8]))]
    hub = prose(999 + seed, 120)
    rows += [edited(hub, rng, rng.randrange(1, 5)) for _ in range(60)]
    shared = prose(77 + seed, 60)
    rows += [shared + " " + prose(5000 + k, 60) for k in range(40)]
    rows += [rows[0]] * 5 + [("rep " * 40 + prose(3, 10)), ("rep " * 44 + prose(3, 10)), ("rep " * 400 + prose(3, 10))]
    rng.shuffle(rows)
    return list(enumerate(rows))


def found(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.class_id].append(r.doc_id)
    for c, own in out.items():
        assert c == min(own)
    return sorted(sorted(x) for x in out.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_agree_with_brute_force(docs, seed):
    rows = table(seed)
    got = near_dedup.near_groups(docs(*rows).repartition(5)).collect()
    assert found(got) == classes(rows)
    kept = [r for r in got if r.kept]
    assert sorted(r.doc_id for r in kept) == [c[0] for c in classes(rows)]
    assert all(r.class_size == len(c) for c in classes(rows) for r in got if r.doc_id in c)


def test_darts_agree_as_often_as_texts_are_similar():
    rng = random.Random(3)
    base = prose(5, 300)
    pairs = [(base, edited(base, rng, n)) for n in (2, 5, 10, 25)] + [("w " * 30 + prose(1, 30), "w " * 60 + prose(1, 30)), (prose(1, 7), edited(prose(1, 7), rng, 1))]
    k = 4000
    for a, b in pairs:
        signature = near_dedup.dart_signatures(*near_dedup.cells_of([a, b]), k)
        rate = (signature[0] == signature[1]).mean()
        want = weighted(bag(a), bag(b))
        assert abs(rate - want) < 5 * (want * (1 - want) / k) ** 0.5 + 0.005


def test_signatures_do_not_depend_on_the_batch():
    texts = [prose(k, n) for k, n in enumerate([1, 3, 6, 50, 400, 3000])] + [""]
    whole = near_dedup.dart_signatures(*near_dedup.cells_of(texts), 216)
    for i, t in enumerate(texts):
        assert (near_dedup.dart_signatures(*near_dedup.cells_of([t]), 216, darts=500)[0] == whole[i]).all()
    assert not whole[-1].any() and whole[:-1].all()


def test_large_buckets_are_compared_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    monkeypatch.setattr(near_dedup, "STARS", 1)
    rows = table(6)
    assert found(near_dedup.near_groups(docs(*rows).repartition(3)).collect()) == classes(rows)


def test_similarities_are_exact():
    texts = [prose(k % 3, 80) + " " + prose(50 + k, 5 * k) for k in range(12)] + ["w " * 40, "w " * 60]
    cell, bounds = near_dedup.cells_of(texts)
    t = pa.table({"cells": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(cell.view(np.int64)))})
    got = near_dedup.similarities(t.slice(0, 6), t.slice(3))
    for i in range(6):
        for j in range(11):
            assert abs(got[i, j] - weighted(bag(texts[i]), bag(texts[3 + j]))) < 1e-6


def test_with_shuffle_joins(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 0)
    rows = table(4)[:60]
    assert found(near_dedup.near_groups(docs(*rows)).collect()) == classes(rows)


def test_odd_rows(odd):
    got = near_dedup.near_groups(odd).collect()
    assert len(got) == odd.count()
    left = near_dedup.drop_near(odd)
    assert left.columns == odd.columns and left.count() == sum(r.kept for r in got) == odd.count() - 1
    assert near_dedup.near_groups(odd.limit(0)).collect() == []
    assert near_dedup.drop_near(odd.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(201, 200), (200, 201), (300, 300)]
    order = rng.permutation(len(edges))
    got = {r.node: r.comp for r in components(spark.createDataFrame([edges[i] for i in order], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + k: 100 for k in range(40)} | {200: 200, 201: 200}
    first = components(spark.createDataFrame(edges[::2], "a long, b long"))
    added = components(spark.createDataFrame(edges[1::2], "x long, y long"), "x", "y", first)
    assert {r.node: r.comp for r in added.filter("node <> 300").collect()} == got


def test_blocks_of_a_cluster_are_dealt_out(spark):
    import pyarrow as pa

    from ledgerloom.llm import blocks

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = []
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        stored = blocks.store
        blocks.store = lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df, label)
        placed = spark.range(40).selectExpr("id AS node", "id % 2 AS cluster", "id % 4 = 0 AS outside")
        found = blocks.in_blocks(placed, 4, lambda x, y: pa.table({"n": pa.array([len(x) * len(y)])}), "n long")
        assert found.groupBy().sum("n").first()[0] == 20 * 10 + 0 * 20
    finally:
        blocks.store = stored
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(cluster" in plans[0] and ", row" in plans[0] and "column" in plans[0].split("hashpartitioning(cluster")[1][:60]
