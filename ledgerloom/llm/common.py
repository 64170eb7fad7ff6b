"""What several operators of this package share: tables, folds, samples, Arrow batches, word rules."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these; `bytes.split()` cuts at exactly the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts of one numpy pass hold at most so many code points; a longer text is cut into overlapping pieces.
PASS_CHARS = 1 << 20
#: Rows of whole texts that Spark hands to Python at once, at most; both sides hold such a batch outside the heap.
BATCH_ROWS = 1000
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ..., so that no name of theirs meets one of an operator's.

    ``toDF(*docs.columns)`` gives them back.
    """
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def named(column: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of crc32 of the id as text. A null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % folds


def bounded_sample(rows: DataFrame, group: str, per_group: int, key: list[str], groups: int = 256) -> DataFrame:
    """About ``per_group`` rows of each value of ``group``, all of them where there are fewer.

    The choice is a threshold on a hash of ``key``, so it doesn't depend on partitions, and costs one count
    per group. Of more than ``groups`` values the most frequent ones are taken, ties by value; only their counts
    reach the driver. Null is no value.
    """
    counted = rows.filter(F.col(group).isNotNull()).groupBy(group).count()
    counts = {r[group]: r["count"] for r in counted.orderBy(F.col("count").desc(), group).limit(groups + 1).collect()}
    taken = dict(list(counts.items())[:groups])
    if len(counts) == len(taken) and all(n <= per_group for n in taken.values()):
        return rows.filter(F.col(group).isNotNull())
    if not taken:
        return rows.limit(0)
    limits = F.create_map(*[F.lit(x) for value, n in taken.items() for x in (value, min(1 << 30, int((1 << 30) * per_group / n)))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 30))
    return rows.filter(draw < F.try_element_at(limits, F.col(group)))


def slices(batch: pa.RecordBatch, column: str, chars: int = PASS_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts (or lists) of each part hold about ``chars`` characters (or elements), one text at least."""
    cells = batch.column(column)
    sizes = (pc.list_value_length if pa.types.is_list(cells.type) else pc.binary_length)(cells).to_pylist()
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + (n or 0) > chars:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n or 0
    if begin < len(sizes):
        yield batch.slice(begin)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def give_back() -> None:
    """Return freed memory to the system, which libraries keep otherwise while their Python worker waits for a task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def in_batches(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` for rows with whole texts: batches of few rows, and workers that give back a task's memory.

    The batch size stays set in the session, as plans read it when they run.
    """
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(RECORDS)) <= BATCH_ROWS:
        conf.set(RECORDS, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return rows.mapInArrow(run, schema)


def map_texts(docs: DataFrame, text_col: str, added: dict[str, str], of_texts: Callable[[list[str]], list],
              chars: int = PASS_CHARS) -> DataFrame:
    """``docs`` with the columns ``added`` (name to type), which replace columns of their names.

    ``of_texts`` gives an array for each of them from texts of some ``chars`` characters, null texts as empty ones.
    """
    names = [c for c in docs.columns if c not in added]
    held = plain(docs.select(*map(named, names)))
    text = held.columns[names.index(text_col)]
    new = [f"n{k}" for k in range(len(added))]
    out = [*held.columns, *new]
    schema = held.withColumns({n: F.lit(None).cast(kind) for n, kind in zip(new, added.values(), strict=True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, chars):
                found = of_texts(texts_of(part, text))
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, found)], names=out)

    return in_batches(held, run, schema).toDF(*names, *added)
