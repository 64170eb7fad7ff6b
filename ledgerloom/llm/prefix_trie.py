"""The trie of all conversations' prefixes: who shares which first turns, and what that saves.

A prefix is known by its depth and by sums of hashes of its turns, each with its place, so that the prefixes of a
conversation are running sums, and a very long conversation is cut into chunks like any window. Most prefixes belong to
one conversation only. A count-min sketch of all prefix digests finds them: an estimate of one proves a singleton, whose
node is complete where its row is; only rows with a larger estimate are shuffled and grouped exactly.

No step walks the tree. The smallest member of a node owns it, and what a conversation owns is the end of its path: it
doesn't own its first ``u`` nodes, and owns all below. So sums over a node's subtree, where each node counts once, are
sums over its members, where each one counts what it owns at or below that depth:

* saved tokens, bytes of all members less bytes of each node once, come to the bytes of each member's not owned prefix
  that lie below the node's parent;
* a leaf is counted by its owner, and a child by the member that owns it and has u up to this depth.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import named
from ledgerloom.operators.stored import store
from ledgerloom.operators.windows import group_count, hot_groups, row_number, running_sum, with_group_metrics

LIMBS = 4
#: Rows of the sketch, and the most cells of one: a task holds their counts (a byte each), the broadcast a bit for each.
#: Beyond some ten million prefixes more of them pass as possibly shared; what they are is found exactly either way.
SKETCH_ROWS, MOST_CELLS = 3, 1 << 25
#: Cells of a block of the sketch, and the blocks of one number that are merged at a time.
BLOCK, FAN_IN = 1 << 16, 64
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefixes(turns: DataFrame, conv: str, order: list[str], role: str, text: str) -> DataFrame:
    """Each turn as the end of a prefix: conversation, depth, digests of the prefix and the one before, bytes of the
    text and of those before, and the conversation's turns."""
    said = [F.coalesce(named(x), F.lit("")) for x in (role, text)]
    base = turns.filter(named(conv).isNotNull()).select(
        named(conv).cast("long").alias("c"), *[named(x).alias(f"o{k}") for k, x in enumerate(order)],
        F.unhex(F.sha2(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said), 256)).alias("said"),
        F.octet_length(said[1]).cast("long").alias("bytes"),
    )
    base = store(base, "turns")
    by = [F.col(f"o{k}").asc_nulls_first() for k in range(len(order))] + [F.col("said")]
    hot = hot_groups(base, {"c": F.col("c")})
    placed = with_group_metrics(base, ["c"], by, [row_number("depth"), group_count("n")], hot)
    limbs = {f"l{k}": F.xxhash64(F.lit(k), "depth", "said").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(LIMBS)}
    placed = placed.select("c", "depth", "n", "bytes", *[x.alias(name) for name, x in limbs.items()])
    sums = [running_sum(name, f"s{name}") for name in limbs]
    summed = with_group_metrics(placed, ["c"], [F.col("depth")], [*sums, running_sum("bytes", "so_far")], hot)

    def digest(depth: Column, parts: list[Column]) -> Column:
        return F.unhex(F.substring(F.sha2(F.concat_ws(",", *[x.cast("string") for x in (depth, *parts)]), 256), 1, 32))

    here = [F.col(f"s{name}") for name in limbs]
    above = [F.col(f"s{name}") - F.col(name) for name in limbs]
    return summed.select(
        "c", "depth", "n", "bytes", (F.col("so_far") - F.col("bytes")).alias("before"),
        digest(F.col("depth"), here).alias("key"), digest(F.col("depth") - 1, above).alias("above"))


def cells(digests: pa.Array, width: int) -> np.ndarray:
    """The cells of each 16-byte digest, one in each row of the sketch."""
    halves = np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 2)
    step = halves[:, 1] | np.uint64(1)
    own = [((halves[:, 0] + np.uint64(k) * step) & np.uint64(width - 1)).astype(np.int64) + k * width for k in range(SKETCH_ROWS)]
    return np.stack(own) if len(halves) else np.zeros((SKETCH_ROWS, 0), np.int64)


def shared_cells(rows: DataFrame, width: int) -> np.ndarray:
    """A bit for each cell of the sketch of all digests: whether it was counted twice or more.

    Each task counts its own rows, up to two; blocks of cells are then merged ``FAN_IN`` at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = np.zeros(SKETCH_ROWS * width, np.uint8)
        for batch in batches:
            for row in cells(batch.column("key"), width):
                at, n = np.unique(row, return_counts=True)
                counted[at] = np.minimum(counted[at] + np.minimum(n, 2).astype(np.uint8), 2)
        for k, block in enumerate(counted.reshape(-1, min(BLOCK, width))):
            if block.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([zlib.compress(block.tobytes(), 1)])], names=["block", "counts"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(min(BLOCK, width), np.uint8)
        for counts in table.column("counts"):
            total = np.minimum(total + np.frombuffer(zlib.decompress(counts.as_py()), np.uint8), 2)
        return table.slice(0, 1).select(["block", "slot"]).append_column("counts", pa.array([zlib.compress(total.tobytes(), 1)]))

    parts = rows.select("key").mapInArrow(count, "block long, counts binary").withColumn("slot", F.spark_partition_id().cast("long"))
    parts = store(parts, "sketch")
    slots = (parts.agg(F.max("slot")).first()[0] or 0) + 1
    while slots > 1:
        slots = -(-slots // FAN_IN)
        parts = store(parts.withColumn("slot", F.floor(F.col("slot") / FAN_IN)).groupBy("block", "slot").applyInArrow(
            merge, "block long, slot long, counts binary"), "sketch")
    bits = np.zeros(SKETCH_ROWS * width, bool)
    for row in parts.select("block", "counts").toLocalIterator():  # a bounded number of bounded blocks
        block = np.frombuffer(zlib.decompress(row["counts"]), np.uint8) > 1
        bits[row["block"] * len(block) : (row["block"] + 1) * len(block)] = block
    return np.packbits(bits)


def screened(rows: DataFrame) -> DataFrame:
    """``rows`` with ``maybe`` and ``above_maybe``: whether the prefix, and the one before it, may be shared."""
    width = 1 << 10
    n = rows.count()
    while width < MOST_CELLS and width < 4 * n:
        width *= 2
    bits = rows.sparkSession.sparkContext.broadcast(shared_cells(rows, width).tobytes())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            found = []
            for column in ("key", "above"):
                at = cells(batch.column(column), width)
                found.append(pa.array((held[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "maybe", "above_maybe"])

    schema = rows.withColumns({"maybe": F.lit(True), "above_maybe": F.lit(True)}).schema
    return store(rows.mapInArrow(look, schema), "screened")


def list_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of each key, joined by commas, without gathering them.

    Sorted stretches of a key are joined where they lie; one task then reads a key's stretches in order and feeds them to
    the hash, which can't be split, holding one stretch at a time.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("c").to_pylist()
            out, first = [], 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[first]:
                    out.append((keys[first], ids[first], ",".join(map(str, ids[first:i]))))
                    first = i
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], names=["key", "c", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.binary(), pa.string()), strict=True)], names=["key", "ends"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends"])

    stretches = ends.select("key", "c").repartitionByRange("key", "c").sortWithinPartitions("key", "c").mapInArrow(join, "key binary, c long, ids string")
    return stretches.repartition("key").sortWithinPartitions("key", "c").mapInArrow(hashed, "key binary, ends string")


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", order: list[str] | None = None,
                role: str = "role", text: str = "text") -> DataFrame:
    """A row per distinct prefix of the conversations in ``turns``: each sequence of first turns (role, text), from the
    empty one on, with the columns ``NODE``.

    ``conv_id`` is the smallest member, a member being a conversation that begins with the prefix; ``parent_conv_id`` is
    the parent's (root: null). ``n_leaves`` counts childless nodes of the subtree, itself included; ``saved_tokens`` adds
    up over it the UTF-8 bytes of a node's last text, times its members less one; ``ends_sha256`` is the hash of the ids of
    the conversations that end there, ascending, joined by commas (of the empty string if none does).

    Turns are taken by ``order`` (["turn"] if not given), nulls first, and ties by a hash of what is said, so that
    repeated rows are turns of their own. A null role or text is empty; turns without a conversation id are left out.
    ``ids`` (first column) lists the conversations, those without turns too; without it they are those of ``turns``. Ids
    are whole numbers. Other columns aren't read. Without any conversation there is no node.
    """
    rows = store(prefixes(turns, conv, order or ["turn"], role, text), "prefixes")
    if ids is None:
        ids = rows.filter("depth = 1").select("c")
    else:
        ids = ids.select(named(ids.columns[0]).cast("long").alias("c")).filter("c IS NOT NULL")
    ids = store(ids.unionByName(rows.filter("depth = 1").select("c")).distinct(), "ids")
    smallest = ids.agg(F.min("c")).first()[0]
    seen = screened(rows)
    shared = seen.filter("maybe")

    # exact groups of what may be shared, and what of its path each conversation doesn't own
    groups = shared.groupBy("key").agg(F.min("c").alias("first"), F.bool_or(F.col("n") > F.col("depth")).alias("longer"))
    held = store(shared.drop("above", "maybe", "above_maybe").join(groups, "key"), "shared")
    other = F.col("first") != F.col("c")
    owning = store(held.groupBy("c").agg(
        F.count_if(other).alias("u"), F.coalesce(F.sum(F.when(other, F.col("bytes"))), F.lit(0)).alias("not_owned"),
        F.max(F.when(other, F.struct("depth", "first")))["first"].alias("above"),
        F.bool_or((F.col("depth") == F.col("n")) & F.col("longer")).alias("ends_inside"), F.max("n").alias("turns"),
    ).withColumn("leaf", ((F.col("u") < F.col("turns")) & ~F.col("ends_inside")).cast("long")).drop("ends_inside"), "owning")

    def parent(u: Column, above: Column) -> Column:
        """The parent's smallest member, seen from the owner of a node."""
        up = F.col("depth") - 1
        return F.when(up == 0, F.lit(smallest)).when(up > u, F.col("c")).otherwise(above)

    def number(x: Column) -> Column:
        return F.sum(x.cast("long"))

    nodes = held.join(owning.drop("turns"), "c").groupBy("key").agg(
        F.min("c").alias("conv_id"), F.max("depth").alias("depth"),
        F.max(F.when(F.col("c") == F.col("first"), parent(F.col("u"), F.col("above")))).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        number((F.col("u") <= F.col("depth")) & (F.col("depth") < F.col("n"))).alias("n_children"),
        number(F.col("leaf")).alias("n_leaves"),
        number(F.greatest(F.col("not_owned") - F.col("before"), F.lit(0))).alias("saved_tokens"),
    )
    # the root, whose members are all conversations; those without turns end there
    zero = F.lit(0).cast("long")
    root = (
        ids.select("c", F.lit(1).cast("long").alias("n"), zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))
        .unionByName(rows.filter("depth = 1").select("c", zero.alias("n"), (zero + 1).alias("children"), (zero + 1).alias("leaves"), zero.alias("saved")))
        .unionByName(owning.select("c", zero.alias("n"), F.when(F.col("u") > 0, -1).otherwise(0).cast("long").alias("children"),
                                   (F.col("leaf") - 1).alias("leaves"), F.col("not_owned").alias("saved")))
        .agg(F.min("c").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.sum("n").alias("n_convs"),
             F.sum("children").alias("n_children"), F.greatest(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        .filter("n_convs > 0").select(F.lit(b"").alias("key"), "*")
    )
    turnless = ids.join(rows.filter("depth = 1").select("c"), "c", "left_anti").select(F.lit(b"").alias("key"), "c")
    ends = list_digests(shared.filter("depth = n").select("key", "c").unionByName(turnless))
    nodes = nodes.select(*root.columns).unionByName(root).join(ends, "key", "left")
    nodes = nodes.withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit(""), 256)))

    # proven singletons; only below a prefix that may be shared is the parent another conversation's
    alone = seen.filter("NOT maybe")
    below = (F.col("depth") > 1) & F.col("above_maybe")

    def single(rows: DataFrame, up: Column) -> DataFrame:
        more = F.col("depth") < F.col("n")
        return rows.select(
            F.col("c").alias("conv_id"), "depth", up.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
            more.cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"),
            F.sha2(F.when(more, "").otherwise(F.col("c").cast("string")), 256).alias("ends_sha256"))

    heads = alone.filter(below).drop("above").join(owning.select("c", "u", "above"), "c", "left")
    tails = single(alone.filter(~below), parent(F.lit(0), F.col("c")))
    return nodes.select(*NODE).unionByName(single(heads, parent(F.coalesce("u", F.lit(0)), F.col("above")))).unionByName(tails)
