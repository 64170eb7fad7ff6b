"""Pack tokenised documents into sequences of a fixed length by minimum bin slack.

Documents longer than a sequence fill whole sequences first; what remains of each, its remainder, has one of
``capacity`` - 1 lengths. The plan is made on the histogram of these lengths, which is as large for any corpus: the
longest remainder opens a sequence, a subset-sum dynamic program on bitsets finds the multiset of lengths that comes
closest to its capacity, backtracking gives the counts, and the sequence is repeated as often as the counts allow.
Where no multiset fits exactly, the gap is closed with a piece cut from a further remainder, whose rest stays in the
histogram. The last tokens, too few for a sequence, go to sequences whose lengths are powers of two.

The plan says which ranks of a length go where. Ranks are numbered within each task of the tokenising pass and made
global by sums over tasks, so that no length, however frequent, is gathered anywhere.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_batches, slices, texts_of
from ledgerloom.llm.word_tokens import WordTokens
from ledgerloom.operators.stored import store

#: Rank offsets are broadcast up to so many rows (24 bytes each), and joined by a shuffle beyond.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Entry:
    """Ranks low <= k < high of remainders ``length`` long: tokens [start, start + size) of each go to slot
    first + k - low; ``per`` slots side by side make a sequence, from ``sequence`` on, at ``offset``."""

    length: int
    low: int
    high: int
    start: int
    size: int
    per: int
    first: int
    sequence: int
    offset: int


@dataclass
class Piece:
    """Ranks low <= k < high of remainders ``length`` long, of which tokens before ``start`` are placed."""

    length: int
    low: int
    high: int
    start: int


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length fill ``capacity`` best, the longest among them: bitset subset sums, then backtracking."""
    longest = max(counts)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        times = 1
        while left > 0 and not reach >> room & 1:
            n = min(times, left)
            steps.append((reach, length, n))
            reach |= (reach << length * n) & mask
            left, times = left - n, times * 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = defaultdict(int, {longest: 1})
    for before, length, n in reversed(steps):
        if not before >> at & 1:
            chosen[length] += n
            at -= length * n
    return dict(chosen)


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Entry], int]:
    """Where the ranks of each remainder length go, and how many sequences that takes."""
    stock: dict[int, list[Piece]] = defaultdict(list)
    counts: dict[int, int] = {}
    for length, n in sorted(histogram.items()):
        if length and n:
            stock[length].append(Piece(length, 0, n, 0))
            counts[length] = n
    entries: list[Entry] = []
    sequence = 0

    def take(size: int, n: int, per: int, offset: int, cut: int = 0) -> None:
        """Place ``n`` pieces of ``size``; with ``cut``, only so many tokens of each, and the rest goes back."""
        placed = 0
        while placed < n:
            piece = stock[size][-1]
            high = min(piece.high, piece.low + n - placed)
            entries.append(Entry(piece.length, piece.low, high, piece.start, cut or size, per, placed, sequence, offset))
            if cut:
                stock[size - cut].append(Piece(piece.length, piece.low, high, piece.start + cut))
                counts[size - cut] = counts.get(size - cut, 0) + high - piece.low
            placed += high - piece.low
            if high == piece.high:
                stock[size].pop()
            else:
                piece.low = high
        counts[size] -= n
        if not counts[size]:
            del counts[size]

    while counts:
        chosen = fullest(counts, capacity)
        gap = capacity - sum(length * m for length, m in chosen.items())
        times = min(counts[length] // m for length, m in chosen.items())
        donor = 0
        if gap:
            # of what the sequences leave, the longest that is longer than the gap
            for length in sorted(counts, reverse=True):
                if length > gap and counts[length] > chosen.get(length, 0):
                    donor = length
                    break
            if not donor:
                break
            times = min(times, counts[donor] // (chosen.get(donor, 0) + 1))
        offset = 0
        for length, m in sorted(chosen.items(), reverse=True):
            take(length, times * m, m, offset)
            offset += length * m
        if donor:
            take(donor, times, 1, offset, cut=gap)
        sequence += times
    # what is left fits in less than a sequence, or in sequences of which each takes all
    left = sum(length * n for length, n in counts.items())
    offset, room = 0, 0
    while left:
        if not room:
            offset, room = 0, 1 << (min(left, capacity).bit_length() - 1)
            space = room
        size = max(counts)
        part = min(size, room)
        take(size, 1, 1, offset, cut=part if part < size else 0)
        offset, room, left = offset + part, room - part, left - part
        if not room:
            sequence += 1
            assert offset == space
    return entries, sequence


def tokenised(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """A row per document: tokens (two bytes each), their number, task, rank of the remainder in the task,
    and full sequences of the task before it."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens.of(tokenizer)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        full = 0
        for batch in batches:
            for part in slices(batch, "text", 1 << 22):
                ids = words.encode(texts_of(part, "text"), end_id)
                n = np.array([len(x) // 2 for x in ids])
                ranks, before = [], []
                for k in n.tolist():
                    ranks.append(seen[k % capacity])
                    seen[k % capacity] += 1
                    before.append(full)
                    full += k // capacity
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(n % capacity, pa.int32()),
                     pa.array([task] * len(n), pa.int32()), pa.array(ranks, pa.int64()), pa.array(before, pa.int64())],
                    names=["id", "ids", "n", "rest", "task", "rank", "full"])
        words.forget()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return store(in_batches(rows, encode, f"id {kind}, ids binary, n long, rest int, task int, rank long, full long"), "tokens")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """A row per piece: id, start (tokens of its document before it), length, ids (little-endian, four bytes each),
    doc_tokens, sequence_id and offset (place in the sequence).

    A document is the tokens of its text and ``end_id``. Each token lies in one piece; a sequence's pieces fill it
    without gap. A null or empty text is the end token alone. Rows that repeat an id are documents of their own.
    Other columns aren't read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    tokens = tokenised(docs, tokenizer, capacity, end_id, id_col, text_col)
    kind = tokens.schema["id"].dataType.simpleString()
    each = tokens.groupBy("rest", "task").agg(F.count(F.lit(1)).alias("n"))
    whole = tokens.groupBy("task").agg(F.sum(F.floor(F.col("n") / capacity)).alias("n")).select(F.lit(-1).alias("rest"), "task", "n")
    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sums = store(each.unionByName(whole).withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "rank-sums")
    histogram = {r["rest"]: r["n"] for r in sums.filter("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    entries, sequences = plan(histogram, capacity)
    by: dict[int, dict[int, list[Entry]]] = defaultdict(lambda: defaultdict(list))
    for e in entries:
        by[e.length][e.start].append(e)
    ranges = {length: [([e.low for e in own], own) for own in (sorted(x, key=lambda e: e.low) for x in starts.values())] for length, starts in by.items()}
    shared = spark.sparkContext.broadcast(ranges)

    bases = sums.filter("rest >= 0").select("rest", "task", "base")
    windows = sums.filter("rest = -1").select("task", F.col("base").alias("whole"))
    bases = bases.join(windows, "task")
    if sums.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = tokens.join(bases, ["rest", "task"]).select("id", "ids", "n", "rest", F.col("rank") + F.col("base"), F.col("full") + F.col("whole"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = shared.value
        for batch in batches:
            for part in slices(batch, "ids", 1 << 22):
                out: list[tuple] = []
                for doc_id, raw, n, rest, rank, full in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    ids = np.frombuffer(raw, "<u2").astype("<u4")
                    for k in range(n // capacity):
                        out.append((doc_id, k * capacity, capacity, ids[k * capacity:(k + 1) * capacity].tobytes(), n, sequences + full + k, 0))
                    begin = n - rest
                    for lows, own in ranges.get(rest, ()):
                        k = bisect.bisect_right(lows, rank) - 1
                        if k >= 0 and rank < own[k].high:
                            e = own[k]
                            slot, at = e.first + rank - e.low, begin + e.start
                            out.append((doc_id, at, e.size, ids[at:at + e.size].tobytes(), n, e.sequence + slot // e.per, e.offset + slot % e.per * e.size))
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], part.schema.field(0).type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()), *[pa.array(c, pa.int64()) for c in columns[4:]]], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    made = in_batches(placed, cut, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return made.withColumnRenamed("id", id_col)
