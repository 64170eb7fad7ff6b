"""Mix overlapping sources to target weights: a min-cost flow over membership patterns, then seeded documents.

Documents with the same set of sources form a pattern. Each pattern offers its tokens once at no cost, a second time
at cost 1, a third at cost 2, and so on (convex: nothing is repeated while fresh tokens would do); each source takes
its quota from the patterns it is part of. The flow of least cost says how many tokens of a pattern the mix takes.
Patterns and sources are few and their sums are all that reaches the driver; the graph falls apart into components,
which are solved one by one.

A pattern's documents are taken as often as its flow covers them whole, and once more in seeded order, each one that
still fits in the rest of the flow. The place where the next one doesn't fit is found by sums over ranges of the seeded
hash, narrowed twice, so that no task sees more than a small share of a pattern; the order goes on behind it with the
documents that fit in what is missing, until none is left that does.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import named
from ledgerloom.operators.stored import store

#: Ranges of the seeded hash at each of two levels.
BITS = 12


#: What of a pattern is taken once more: behind one place of the seeded order up to another, documents of a size at most.
TAKEN = "array<struct<after_draw:long,after_row:long,draw:long,row:long,most:long>>"


def water_fill(weights: dict, sizes: dict, total: float, most: float) -> dict:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess shared anew among the others."""
    target: dict = {}
    open_, left = dict(weights), float(total)
    while open_:
        unit = left / sum(open_.values())
        above = [s for s, w in open_.items() if w * unit > most * sizes[s]]
        if not above:
            target |= {s: w * unit for s, w in open_.items()}
            break
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
            del open_[s]
        left = max(left, 0.0)
    return target


def least_cost(capacity: dict, member: dict, quota: dict, most: int) -> dict:
    """Tokens that each pattern gives: a flow of least cost, by shortest augmenting paths with potentials.

    ``capacity``: pattern to tokens; ``member``: pattern to its sources; ``quota``: source to tokens wanted.
    """
    flow: dict = defaultdict(int)
    for patterns, sources in components(member):
        for p, n in _least_cost({p: capacity[p] for p in patterns}, member, {s: quota[s] for s in sources}, most).items():
            flow[p] += n
    return flow


def components(member: dict) -> list[tuple[list, list]]:
    of: dict = defaultdict(list)
    for p, own in member.items():
        for s in own:
            of[s].append(p)
    seen, out = set(), []
    for first in member:
        if first in seen:
            continue
        seen.add(first)
        patterns, sources, wait = [], {}, [first]
        while wait:
            p = wait.pop()
            patterns.append(p)
            for s in member[p]:
                if s not in sources:
                    sources[s] = True
                    for q in of[s]:
                        if q not in seen:
                            seen.add(q)
                            wait.append(q)
        out.append((patterns, list(sources)))
    return out


def _least_cost(capacity: dict, member: dict, quota: dict, most: int) -> dict:
    arcs: list[list] = []  # to, room, cost; arc i ^ 1 is its reverse
    at: dict = defaultdict(list)

    def arc(a, b, room, cost) -> None:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            at[x].append(len(arcs))
            arcs.append([y, r, c])

    start, end = ("start",), ("end",)
    copies: dict = defaultdict(list)
    for p, room in capacity.items():
        for again in range(most):
            copies[p].append(len(arcs))
            arc(start, ("p", p), room, again)
        for s in member[p]:
            arc(("p", p), ("s", s), room * most, 0)
    for s, room in quota.items():
        arc(("s", s), end, room, 0)
    potential: dict = defaultdict(int)
    while True:
        distance, by, heap, tick = {start: 0}, {}, [(0, 0, start)], 0
        done = set()
        while heap:
            d, _, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            for i in at[x]:
                y, room, cost = arcs[i]
                if room > 0 and y not in done:
                    new = d + cost + potential[x] - potential[y]
                    if y not in distance or new < distance[y]:
                        distance[y], by[y] = new, i
                        tick += 1
                        heapq.heappush(heap, (new, tick, y))
        if end not in by:
            return {p: sum(arcs[i ^ 1][1] for i in own) for p, own in copies.items()}
        for x in at:
            potential[x] += distance.get(x, distance[end])
        path, x = [], end
        while x != start:
            path.append(by[x])
            x = arcs[by[x] ^ 1][0]
        n = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= n
            arcs[i ^ 1][1] += n


def mix(docs: DataFrame, size: Column, sources: Column, carry: list[str], weights: tuple[float, ...] = (1, 2, 3),
        total_share: float = 1.0, most: int = 3, seed: int = 7, id_col: str = "doc_id") -> DataFrame:
    """The columns ``carry`` of each row, with sources, size, source_size, target and copies (0 to ``most``).

    ``sources`` is an array of text; a null in it, a null array and an empty one all mean the source null, which
    comes last in order. Sources in code point order weigh ``weights``, repeated as often as needed, and share
    ``total_share`` of all sizes; no target is above ``most`` times its source's size. ``source_size`` and
    ``target`` are those of the first of a row's sources. A carried column may have any name; one named like a result
    stands before it, and both are there. Rows that repeat an id are documents of their own. A row
    of size 0 is taken as often as its pattern is whole, and once more where the order comes by. An empty table gives an
    empty result.
    """
    taken, held = _mix(docs, size, sources, carry, weights, total_share, most, seed, id_col)
    results = ("sources", "size", "source_size", "target", "copies")
    return taken.select(*held, *[f"_{c}" for c in results]).toDF(*carry, *results)


def _mix(docs: DataFrame, size: Column, sources: Column, carry: list[str], weights: tuple[float, ...], total_share: float,
         most: int, seed: int, id_col: str) -> tuple[DataFrame, list[str]]:
    """What ``mix`` gives, the carried columns under the names that come with it."""
    spark = docs.sparkSession
    held = [f"c{k}" for k in range(len(carry))]
    of = F.coalesce(sources, F.array(F.lit(None).cast("string")))
    of = F.when(F.size(of) == 0, F.array(F.lit(None).cast("string"))).otherwise(F.sort_array(F.array_distinct(of)))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(named(id_col).cast("string"), F.lit("null"))), 8)
    rows = store(docs.select(
        *[named(c).alias(h) for c, h in zip(carry, held, strict=True)], of.alias("_sources"), size.cast("long").alias("_size"), draw.alias("_draw"),
        F.monotonically_increasing_id().alias("_row")), "to-mix")

    sums = rows.groupBy("_sources").agg(F.sum("_size").alias("n")).collect()
    capacity = {tuple(r["_sources"]): r["n"] for r in sums}
    member = {p: list(p) for p in capacity}
    source_size: dict = defaultdict(int)
    for p, n in capacity.items():
        for s in p:
            source_size[s] += n
    order = sorted(source_size, key=lambda s: (s is None, s or ""))
    target = water_fill({s: weights[k % len(weights)] for k, s in enumerate(order)}, source_size, total_share * sum(capacity.values()), most)
    flow = least_cost(capacity, member, {s: int(t + 1e-6) for s, t in target.items()}, most)
    state = {}
    for p, n in capacity.items():
        whole = min(flow[p] // n, most) if n else 0
        state[p] = {"whole": whole, "gap": flow[p] - whole * n, "draw": -1, "row": -1}

    def with_state(df: DataFrame, of: dict, *keys: str) -> DataFrame:
        kinds = ", ".join(f"{k} {TAKEN if k == 'taken' else 'long'}" for k in keys)
        made = spark.createDataFrame([(list(p), *[x[k] for k in keys]) for p, x in of.items()], f"_pattern array<string>, {kinds}")
        # a row per pattern
        return df.join(F.broadcast(made), F.col("_sources").eqNullSafe(F.col("_pattern"))).drop("_pattern")

    # a round takes, behind the place (draw, row), documents of at most the gap up to the first that doesn't fit any more
    place = F.struct("_draw", "_row")
    for x in state.values():
        x["taken"] = []
    going = {p: x for p, x in state.items() if x["gap"] > 0}
    while going:
        for x in going.values():
            x |= {"below": 0, "range": -1}
        fit = rows.select("_sources", "_size", "_draw", "_row")
        # draws are below 2 ** 56: narrow the place to a range of 2 ** (56 - BITS), then of 2 ** (56 - 2 * BITS)
        for level in (1, 2):
            here = with_state(fit, going, "gap", "draw", "row", "below", "range").filter((F.col("_size") <= F.col("gap")) & (place > F.struct("draw", "row")))
            if level > 1:
                here = here.filter(F.shiftrightunsigned("_draw", 56 - BITS * (level - 1)) == F.col("range"))
            part = F.shiftrightunsigned("_draw", 56 - BITS * level)
            up_to = Window.partitionBy("_sources").orderBy("_part")
            cut = (
                here.withColumn("_part", part).groupBy("_sources", "_part", "gap", "below").agg(F.sum("_size").alias("n"))
                .withColumn("upto", F.col("below") + F.sum("n").over(up_to)).filter("upto > gap")
                .groupBy("_sources").agg(F.min(F.struct("_part", (F.col("upto") - F.col("n")).alias("before"))).alias("at"))
            )
            for r in cut.collect():
                going[tuple(r["_sources"])] |= {"range": r["at"]["_part"], "below": r["at"]["before"]}
            # without a range all that is left fits
            for x in [x for x in going.values() if x["range"] < 0]:
                x["taken"].append((x["draw"], x["row"], 1 << 56, -1, x["gap"]))
            going = {p: x for p, x in going.items() if x["range"] >= 0}
            if not going:
                break
        if not going:
            break
        shift = 56 - 2 * BITS
        last = with_state(fit, going, "gap", "draw", "row", "below", "range").filter(
            (F.col("_size") <= F.col("gap")) & (place > F.struct("draw", "row")) & (F.shiftrightunsigned("_draw", shift) == F.col("range")))
        in_order = Window.partitionBy("_sources").orderBy("_draw", "_row")
        fits = last.withColumn("upto", F.col("below") + F.sum("_size").over(in_order)).filter("upto <= gap")
        ends = {tuple(r["_sources"]): r["at"] for r in fits.groupBy("_sources").agg(F.max(F.struct("_draw", "_row", "upto")).alias("at")).collect()}
        for p, x in going.items():
            draw, row, upto = ends.get(p, (x["range"] << shift, -1, x["below"]))
            x["taken"].append((x["draw"], x["row"], draw, row, x["gap"]))
            x |= {"draw": draw, "row": row, "gap": x["gap"] - upto}
        going = {p: x for p, x in going.items() if x["gap"] > 0}

    result = with_state(rows, state, "whole", "taken")
    once_more = F.exists("taken", lambda t: (
        (F.col("_size") <= t["most"]) & (place > F.struct(t["after_draw"], t["after_row"])) & (place <= F.struct(t["draw"], t["row"]))))
    wanted = F.broadcast(spark.createDataFrame([(s, source_size[s], float(target[s])) for s in order], "_first string, _source_size long, _target double"))
    copies = F.col("whole") + F.when(once_more & (F.col("whole") < most), 1).otherwise(0)
    mixed = result.withColumns({"_first": F.element_at("_sources", 1), "_copies": copies.cast("long")})
    return mixed.join(wanted.withColumnRenamed("_first", "_of"), F.col("_first").eqNullSafe(F.col("_of"))), held


def mixed_rows(docs: DataFrame, size: Column, sources: Column, weights: tuple[float, ...] = (1, 2, 3),
               total_share: float = 1.0, most: int = 3, seed: int = 7, id_col: str = "doc_id") -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as it has copies, all columns kept."""
    taken, held = _mix(docs, size, sources, docs.columns, weights, total_share, most, seed, id_col)
    again = taken.filter("_copies > 0").withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
    return again.select(*held).toDF(*docs.columns)
