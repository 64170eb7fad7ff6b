"""Near duplicates by DartMinHash: weighted signatures, banded joining, exact verification, connected classes.

A text's elements are its five-word shingles, an element's weight is how often the text has it, and the similarity of
two texts is the weighted Jaccard similarity. Darts are thrown at random, by hash, over each element's region (weight x
rank); a text is hit by those below its elements' weights and below a rank that gives it about k ln k + 2k darts. Every
dart belongs to one of k coordinates; a coordinate keeps its earliest dart. Two texts keep the same dart with a
probability that is their similarity, and the cost of a signature doesn't depend on k times the text's length.

Coordinates are taken in bands of ``ROWS``; texts that agree in a band are candidates. With 36 bands of 6, a pair of
similarity 0.8 is missed with a probability of 2e-5. Texts with the same elements are one node. In a band's bucket,
nodes are compared with one leader, in ``STARS`` rounds with other leaders. Then whatever a bucket has that the links
found so far don't connect is compared as well, so that no link between two classes is lost:

* In buckets of up to ``SMALL`` nodes pair by pair, unless their sketches (a bit per coordinate) agree so seldom that a
  similarity of 0.8 is five standard deviations away.
* Larger buckets that share nodes form a cluster. Its nodes outside the largest class found so far meet all its nodes
  in blocks of ``BLOCK``; a block counts shared elements as a product of two matrices, and gives one link for each
  node and class that it finds alike.

So a group of copies of any size gives as many candidates as it has nodes. All are verified on all their elements.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import clusters, in_blocks, main_comp
from ledgerloom.llm.common import in_batches, slices, texts_of
from ledgerloom.llm.components import components
from ledgerloom.llm.exact_dedup import staying
from ledgerloom.llm.word_hashes import GOLDEN, cells, mix, shingles, word_hashes
from ledgerloom.operators.stored import store

BANDS, ROWS = 36, 6
STARS = 3
SMALL, BLOCK = 64, 256
#: Elements that one matrix product of a block takes at once.
COLUMNS = 8192
#: Ranks [0, FIRST_RANK) are the first area; each further one is as long as all before it.
FIRST_RANK = 1 / 16
#: Ids of rows to be read again are broadcast up to so many (some 60 bytes each), and joined by a shuffle beyond.
BROADCAST_ROWS = 400_000


def poisson_steps(mean: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts."""
    p, total, out = np.exp(-mean), 0.0, []
    for k in range(1, int(mean + 12 * mean ** 0.5 + 24)):
        total += p
        out.append(total)
        p *= mean / k
    return np.array(out)


def dart_signatures(cell: np.ndarray, bounds: np.ndarray, k: int, darts: int = 1 << 19) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates, a row per text; texts without cells keep zeros.

    ``cell``: unit cells of weight, text after text; ``darts`` bounds how many are held at once.
    """
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), k), np.uint64)
    wanted = k * np.log(k) + 2 * k
    limit = wanted / np.maximum(sizes, 1)
    todo = np.flatnonzero(sizes > 0)
    while len(todo):
        again = []
        weight = np.maximum(limit[todo], FIRST_RANK) * sizes[todo]
        part = np.floor(np.cumsum(weight) / darts).astype(int)
        for p in np.unique(part):
            texts = todo[part == p]
            n = sizes[texts]
            own = np.repeat(np.arange(len(texts)), n)
            at = np.repeat(bounds[texts] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            keys, limits = cell[at], limit[texts][own]
            rank = np.full(len(texts) * k, np.inf)
            dart = np.zeros(len(texts) * k, np.uint64)
            low, high, level = 0.0, FIRST_RANK, 0
            while True:
                live = limits > low
                if not live.any():
                    break
                key, owner, most = keys[live], own[live], limits[live]
                seed = mix(key + np.array([level + 1], np.uint64) * GOLDEN)
                times = np.searchsorted(poisson_steps(high - low), (seed >> np.uint64(11)) * 2.0 ** -53, side="right")
                ends = np.cumsum(times)
                number = np.arange(ends[-1]) - np.repeat(ends - times, times)
                thrown = mix(np.repeat(seed, times) + (number + 1).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
                ranks = low + (high - low) * ((thrown >> np.uint64(11)) * 2.0 ** -53)
                slot = np.repeat(owner, times) * k + (mix(thrown) % np.uint64(k)).astype(np.int64)
                # darts of a further area are later than all before
                hit = (ranks < np.repeat(most, times)) & np.isinf(rank[slot])
                thrown, ranks, slot = thrown[hit], ranks[hit], slot[hit]
                np.minimum.at(rank, slot, ranks)
                first = rank[slot] == ranks
                dart[slot[first]] = thrown[first]
                low, high, level = high, 2 * high, level + 1
            full = ~np.isinf(rank).reshape(-1, k).any(1)
            out[texts[full]] = dart.reshape(-1, k)[full]
            again.append(texts[~full])
        # a coordinate without a dart: throw twice as far
        todo = np.concatenate(again)
        limit[todo] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band, the band's number in it."""
    h = np.zeros((len(signature), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN
    for r in range(rows):
        h = mix(h + signature[:, r::rows][:, :bands])
    return h


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per row: id, row number, digest of the elements (null without any), their number, bands, sketch."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("sha"))
    kind = rows.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                cell, bounds = cells_of(texts_of(part, "text"))
                signature = dart_signatures(cell, bounds, BANDS * ROWS)
                keys = band_keys(signature, BANDS, ROWS).view(np.int64)
                sketch = np.packbits((mix(signature) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
                sketch = np.pad(sketch, ((0, 0), (0, -sketch.shape[1] % 8))).view(np.int64)
                some = np.diff(bounds) > 0
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("row"), part.column("sha"),
                    pa.array([print_of(cell[a:b]) if b > a else None for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                    pa.array([x if y else None for x, y in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                    pa.array([x if y else None for x, y in zip(sketch, some, strict=True)], pa.list_(pa.int64())),
                ], names=["id", "row", "sha", "print", "bands", "sketch"])

    return store(in_batches(rows, sign, f"id {kind}, row long, sha binary, print binary, bands array<long>, sketch array<long>"), "signed")


def cells_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    hashed, bounds = shingles(*word_hashes(texts))
    return cells(hashed, bounds), bounds


def print_of(cell: np.ndarray) -> bytes:
    return hashlib.blake2b(np.sort(cell).tobytes(), digest_size=16).digest()


def similar(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of cells."""
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """A row per row of ``docs``: id, class_id (smallest id of its class), class_size, kept, text_sha256.

    A class is what links of similarity ``least`` or more connect. Of each class the row with the smallest id stays
    (among repeated ids the first read); a null id comes last. Texts of one to four words are alike when their words
    are equal; texts without words, null ones too, are classes of their own. Other columns aren't read. An empty table
    gives an empty result.
    """
    rows = signed(docs, id_col, text_col)
    # one node for equal elements, found in two steps: a group of copies is first met per part of the table
    part = F.pmod(F.col("row"), F.lit(64)).alias("part")
    some = rows.filter("print IS NOT NULL")
    parts = some.groupBy("print", part).agg(F.min("row").alias("first"))
    firsts = store(parts.join(parts.groupBy("print").agg(F.min("first").alias("node")), "print").select("print", "part", "node"), "firsts")
    nodes = store(
        some.join(firsts.select(F.col("node").alias("row")).distinct(), "row", "left_semi").select(F.col("row").alias("node"), "id", "sha", "bands", "sketch"), "nodes")
    repeated = not some.groupBy("id", "sha").count().filter("count > 1").isEmpty()
    comps = near_components(docs, nodes, repeated, id_col, text_col, least)
    of_node = rows.select("id", "row", "sha", "print", part).join(firsts, ["print", "part"], "left")
    classed = of_node.join(comps, "node", "left").select(
        "id", "row", "sha", F.coalesce("comp", "node", -F.col("row") - 1).alias("class"))
    held = store(classed.withColumn("part", F.pmod(F.col("row"), F.lit(64))), "classed")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    small = held.groupBy("class", "part").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    whole = small.groupBy("class").agg(F.min("best").alias("best"), F.sum("n").alias("class_size"))
    answers = small.select("class", "part").join(whole, "class")
    return held.join(answers, ["class", "part"]).select(
        F.col("id").alias(id_col), F.col("best.id").alias("class_id"), "class_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class of near duplicates, all columns kept."""
    return staying(docs, near_groups(docs, id_col, text_col, least), id_col, text_col)


def near_components(docs: DataFrame, nodes: DataFrame, repeated: bool, id_col: str, text_col: str, least: float) -> DataFrame:
    """Components (node, comp) of the nodes that verified links connect."""
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    buckets = store(banded.join(shared, "key"), "buckets")
    elements = elements_of(docs, nodes, buckets, repeated, id_col, text_col)
    tested = comps = None
    for star in range(STARS):
        here = with_comp(buckets, comps)
        lead = F.min(F.struct((F.xxhash64("node", F.lit(star)) if star else F.col("node")).alias("rank"), "node", "comp")).alias("lead")
        leaders = here.groupBy("key").agg(lead, F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("key", "lead")
        pairs = here.join(leaders, "key").filter("comp <> lead.comp").select(
            F.least("node", F.col("lead.node")).alias("a"), F.greatest("node", F.col("lead.node")).alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        done = verified(pairs, elements)
        tested = done.select("a", "b") if tested is None else tested.unionByName(done.select("a", "b"))
        comps = components(done.filter(F.col("similarity") >= least), known=comps)
    here = with_comp(buckets, comps)
    sizes = here.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("key", "n")
    apart = store(here.join(sizes, "key"), "apart")
    done = verified(small_pairs(apart.filter(F.col("n") <= SMALL), nodes, least).join(tested, ["a", "b"], "left_anti"), elements)
    comps = components(done.filter(F.col("similarity") >= least), known=comps)
    large = apart.filter(F.col("n") > SMALL)
    return comps if large.isEmpty() else components(large_links(large, elements, least), known=comps)


def small_pairs(apart: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of unlike components in a bucket whose sketches allow a link."""
    held = apart.join(main_comp(apart, "key"), "key").join(nodes.select("node", "sketch"), "node")
    return held.filter("comp <> main").alias("x").join(held.alias("y"), (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp"))
        & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
        & (unlike(F.col("x.sketch"), F.col("y.sketch")) <= unlike_most(least))
    )).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def large_links(apart: DataFrame, elements: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between unlike components of clusters of large buckets."""

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        nodes_x, nodes_y = (t.column("node").to_numpy() for t in (x, y))
        comp_x, comp_y = (t.column("comp").to_numpy() for t in (x, y))
        alike = np.argwhere((similarities(x, y) >= least) & (comp_x[:, None] != comp_y[None, :]))
        # one link for each node and component
        _, once = np.unique(np.stack([nodes_x[alike[:, 0]], comp_y[alike[:, 1]]]), axis=1, return_index=True)
        a, b = nodes_x[alike[once, 0]], nodes_y[alike[once, 1]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return in_blocks(clusters(apart).join(elements, "node"), BLOCK, compare, "a long, b long")


def similarities(x: pa.Table, y: pa.Table) -> np.ndarray:
    """Weighted Jaccard similarities of all rows of two tables of cells, exactly."""
    cells_x, sizes_x = flat(x)
    cells_y, sizes_y = flat(y)
    shared = np.intersect1d(cells_x, cells_y)
    found = np.zeros((x.num_rows, y.num_rows), np.float32)
    for begin in range(0, len(shared), COLUMNS):
        part = shared[begin:begin + COLUMNS]
        found += holds(cells_x, sizes_x, part) @ holds(cells_y, sizes_y, part).T
    return found / np.maximum(sizes_x[:, None] + sizes_y[None, :] - found, 1)


def flat(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    column = t.column("cells").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def holds(cell: np.ndarray, sizes: np.ndarray, part: np.ndarray) -> np.ndarray:
    """1 where a row has a cell of the sorted ``part``."""
    out = np.zeros((len(sizes), len(part)), np.float32)
    at = np.searchsorted(part, cell)
    hit = part[np.minimum(at, len(part) - 1)] == cell
    out[np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit]] = 1
    return out


def with_comp(buckets: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return buckets.withColumn("comp", F.col("node"))
    return buckets.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def unlike(s: Column, t: Column) -> Column:
    """Coordinates whose sketch bits differ."""
    out = F.lit(0)
    for k in range(-(-BANDS * ROWS // 64)):
        out = out + F.bit_count(s[k].bitwiseXOR(t[k]))
    return out


def unlike_most(least: float) -> int:
    k, p = BANDS * ROWS, (1 - least) / 2
    return int(k * p + 5 * (k * p * (1 - p)) ** 0.5) + 1


def elements_of(docs: DataFrame, nodes: DataFrame, buckets: DataFrame, repeated: bool, id_col: str, text_col: str) -> DataFrame:
    """Cells of every node that shares a bucket: node, cells. Their texts are read again by id and digest."""
    involved = store(nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", F.col("id").alias("_id"), F.col("sha").alias("_sha")), "involved")
    if involved.count() <= BROADCAST_ROWS:
        involved = F.broadcast(involved)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.unhex(F.sha2(text_col, 256)).alias("sha"))
    texts = texts.join(involved, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))).select("node", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                cell, bounds = cells_of(texts_of(part, "text"))
                found = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(cell.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("node"), found], names=["node", "cells"])

    found = in_batches(texts, count, "node long, cells array<long>")
    # rows that repeat an id and a text give their node's cells again
    return store(found.groupBy("node").agg(F.first("cells").alias("cells")) if repeated else found, "elements")


def verified(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    """Pairs (a, b) with their similarity."""
    a = elements.select(F.col("node").alias("a"), F.col("cells").alias("cells_a"))
    b = elements.select(F.col("node").alias("b"), F.col("cells").alias("cells_b"))
    return store(pairs.join(a, "a").join(b, "b").select("a", "b", similar(F.col("cells_a"), F.col("cells_b")).alias("similarity")), "verified")
