import hashlib
from collections import defaultdict

import pytest

from ledgerloom.llm import exact_dedup


def brute(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        own = groups[text or ""]
        known = [x for x in own if x is not None]
        out.append((doc_id, (max(known) if keep == "largest" else min(known)) if known else None, len(own), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("runs, fan_in", [(1, 2), (5, 2), (None, 2), (64, 8)])
def test_groups_agree_with_brute_force(spark, docs, keep, runs, fan_in):
    rows = [(i, f"text {i % 7}" if i % 3 else "hot") for i in range(200)] + [(500, None), (501, ""), (None, "hot")]
    found = exact_dedup.exact_groups(docs(*rows).repartition(9), keep=keep, runs=runs, fan_in=fan_in).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == brute(rows, keep)
    kept = defaultdict(int)
    for r in found:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_odd_rows_and_drop(odd):
    groups = exact_dedup.exact_groups(odd).collect()
    assert len(groups) == odd.count()
    left = exact_dedup.drop_exact(odd)
    assert left.columns == odd.columns
    texts = [r["text"] or "" for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({r["text"] or "" for r in odd.collect()})


def test_empty(odd):
    assert exact_dedup.exact_groups(odd.limit(0)).collect() == []
    assert exact_dedup.drop_exact(odd.limit(0)).collect() == []


def test_no_python_in_the_plan(docs):
    plan = exact_dedup.exact_groups(docs((1, "a"), (2, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_each_round_is_one_range_exchange_and_one_merge_of_sorted_runs(spark, docs):
    from pyspark.sql import functions as F

    rows = exact_dedup.digests(docs(*[(i, f"t{i % 5}") for i in range(40)]).repartition(8)).withColumn("_best", F.col("_id"))
    top = exact_dedup.sorted_runs(rows.groupBy("_run", *exact_dedup.DIGEST).agg(F.min("_best").alias("_best"), F.count("*").alias("_n")))
    best = F.min(F.struct("_best"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = exact_dedup.merge_runs(top, best, 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # two range exchanges (runs, round), one hash exchange that forms the runs; the merge adds neither exchange nor sort
    assert plan.count("Exchange rangepartitioning") == 2 and plan.count("Exchange hashpartitioning(_run") == 1
    above = plan.split("Exchange rangepartitioning")[0]
    assert above.count("SortAggregate") == 2 and above.count("Sort [") == 1


def test_more_rounds_than_are_kept_in_one_lineage(docs):
    rows = [(i, f"text {i % 11}" if i % 3 else "hot") for i in range(300)]
    found = exact_dedup.exact_groups(docs(*rows).repartition(150), keep="largest").collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == brute(rows, "largest")
    assert sum(r.kept for r in found) == len({t for _, t in rows})
