"""Full rebuilds beside the tables in use: readers are switched over when all is built and checked.

Release n is a database of its own, ``<database>_r<n>``. What readers know, ``<database>_staging`` and
``<database>_marts``, holds views of the tables of one release, and a view is replaced in one step of the catalog. A
rebuild that fails, or whose checks fail, leaves the views as they are; its tables go with the next release. Views keep
buckets, partitions, descriptions and comments of what they show, and a table may change its columns.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import dates
from ledgerloom.plans.build import Models, build_all, saver
from ledgerloom.sources.tables import ensure_database, show_table

RELEASED = "ledgerloom.released"


def _name(database: str, number: int) -> str:
    return f"{database}_r{number}"


def _numbers(spark: SparkSession, database: str) -> list[int]:
    """Every release that has a database, complete or not."""
    named = re.compile(re.escape(database.lower()) + r"_r(\d+)")
    found = (named.fullmatch(d.name.lower()) for d in spark.catalog.listDatabases(f"{database}_r*"))
    return sorted(int(m.group(1)) for m in found if m)


def releases(spark: SparkSession, database: str) -> list[int]:
    """The releases that are complete and checked, old ones first."""
    def complete(number: int) -> bool:
        about = spark.sql(f"DESCRIBE DATABASE EXTENDED `{_name(database, number)}`").collect()
        return any(RELEASED in str(r[1]) for r in about)

    return [n for n in _numbers(spark, database) if complete(n)]


def switch(spark: SparkSession, database: str, number: int) -> None:
    """Show the tables of a release to readers; an older one that is still kept may be shown again.

    Each view is replaced in one step. Views of tables that the release doesn't have are dropped. A switch that stops
    half way leaves views of two releases, all of them readable, until it is run again.
    """
    if number not in releases(spark, database):
        raise LookupError(f"{database} has no complete release {number}")
    held = _name(database, number)
    names = sorted(t.name for t in spark.catalog.listTables(held) if not t.isTemporary)
    for place, staged in ((f"{database}_staging", True), (f"{database}_marts", False)):
        ensure_database(spark, place)
        own = [n for n in names if n.startswith("stg_") == staged]
        for name in own:
            show_table(spark, f"`{held}`.`{name}`", f"`{place}`.`{name}`")
        for t in spark.catalog.listTables(place):
            if not t.isTemporary and t.tableType == "VIEW" and t.name not in own:
                spark.sql(f"DROP VIEW `{place}`.`{t.name}`")


def shown(spark: SparkSession, database: str) -> set[int]:
    """The releases that views show: one, or two after a switch that stopped half way."""
    held = re.compile(re.escape(f"`{database}_r") + r"(\d+)`")
    found = set()
    for place in (f"{database}_staging", f"{database}_marts"):
        for t in spark.catalog.listTables(place) if spark.catalog.databaseExists(place) else ():
            if not t.isTemporary and t.tableType == "VIEW":
                about = spark.sql(f"DESCRIBE EXTENDED `{place}`.`{t.name}`").where("col_name = 'View Text'").collect()
                found.update(int(n) for r in about for n in held.findall(r["data_type"]))
    return found


def prune(spark: SparkSession, database: str, keep: int = 2) -> list[int]:
    """Drop all but the newest ``keep`` complete releases and those shown; says which went. Run it when no build is under way."""
    complete = releases(spark, database)
    kept = {*complete[max(len(complete) - keep, 0):], *shown(spark, database)}
    gone = [n for n in _numbers(spark, database) if n not in kept]
    for number in gone:
        spark.sql(f"DROP DATABASE `{_name(database, number)}` CASCADE")
    return gone


def release(
    spark: SparkSession, raw: DataFrame, database: str, as_of: dt.date | str | None = None, buckets: int | None = None,
    calendar: tuple[str, str] = (dates.FIRST_DAY, dates.LAST_DAY), check: Callable[[Models], None] | None = None, keep: int = 2,
) -> Models:
    """Rebuild all models as the next release, let ``check`` look at them, and switch readers over unless it raises.

    ``keep`` complete releases stay, so that what reads the one before can end in peace.
    """
    number = max(_numbers(spark, database), default=0) + 1
    held = _name(database, number)
    ensure_database(spark, held)
    models = build_all(raw, as_of, saver(spark, held, held, buckets), calendar)
    if check:
        check(models)
    spark.sql(f"ALTER DATABASE `{held}` SET DBPROPERTIES ('{RELEASED}' = 'true')")
    switch(spark, database, number)
    prune(spark, database, keep)
    return models
