"""Load a JSON feed, rebuild all models, run the checks and export the marts.

    python -m ledgerloom --raw orders.jsonl --database shop --export out/
    spark-submit ... -m ledgerloom with the cluster's own settings works alike.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections import Counter

from pyspark.sql import SparkSession

from ledgerloom.checks.suite import ChecksFailed
from ledgerloom.operators.stored import drop_stored
from ledgerloom.plans.build import Models, build
from ledgerloom.plans.dates import FIRST_DAY, LAST_DAY
from ledgerloom.plans.release import release as as_release
from ledgerloom.session import build_session
from ledgerloom.sources.files import read_jsonl
from ledgerloom.sources.tables import Source, ensure_database, export_database, save_table


def run(
    spark: SparkSession, raw: str, database: str, as_of: str | None = None,
    buckets: int | None = None, export: str | None = None, views: bool = False,
    first_day: str = FIRST_DAY, last_day: str = LAST_DAY, at: str | None = None, release: bool = False,
) -> dict:
    """The whole chain in one session; says what was loaded, checked and exported.

    With ``release`` the models are built beside the ones in use, and shown to readers only if no check fails.
    """
    if release and views:
        raise ValueError("a release stores its staged models, so views and release exclude each other")
    source = Source("orders", schema=f"{database}_raw")
    ensure_database(spark, source.schema)
    loaded = save_table(read_jsonl(spark, raw), source.name())
    print(f"Loaded {loaded} rows into {source.name()}.")
    if at == "now":
        at = dt.datetime.now(dt.UTC).strftime("%Y-%m-%d %H:%M:%S")
    report = []

    def check(models: Models) -> None:
        report.extend(models.check(further=True, at=at).collect())  # one row per check
        for row in sorted(report, key=lambda r: (r.status, r.check_name)):
            if row.status != "pass":
                print(f"{row.status}: {row.check_name} ({row.failures} rows)")
        if release and any(r.status == "fail" for r in report):
            raise ChecksFailed("the release isn't shown: " + ", ".join(r.check_name for r in report if r.status == "fail"))

    calendar = (first_day, last_day)
    if release:
        as_release(spark, source.read(spark), database, as_of, buckets, calendar, check)
    else:
        check(build(spark, source.read(spark), database, as_of, buckets, views, calendar))
    exported = export_database(spark, f"{database}_marts", export) if export else {}
    for name, path in exported.items():
        print(f"Exported {name} -> {path}")
    drop_stored(spark)  # tables and exports are written
    return {"loaded": loaded, "checks": dict(Counter(r.status for r in report)), "exported": exported}


def main() -> None:
    parser = argparse.ArgumentParser(prog="ledgerloom", description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True, help="newline-delimited JSON file, folder or glob")
    parser.add_argument("--database", required=True, help="prefix of the _raw, _staging and _marts databases")
    parser.add_argument("--as-of", help="reporting date, today by default")
    parser.add_argument("--buckets", type=int, help="store order-grained tables hashed into so many buckets")
    parser.add_argument("--views", action="store_true", help="publish staged models as views")
    parser.add_argument("--release", action="store_true", help="build beside the tables in use and switch over if no check fails")
    parser.add_argument("--first-day", default=FIRST_DAY, help="calendar begins here, or earlier if an order does")
    parser.add_argument("--last-day", default=LAST_DAY, help="calendar ends here, or later if an order does")
    parser.add_argument("--at", help="check the age of the data and the tables as wholes too, as of this UTC time, or now")
    parser.add_argument("--export", help="folder for CSV copies of the marts")
    args = parser.parse_args()
    done = run(build_session(), **{k: v for k, v in vars(args).items()})
    if done["checks"].get("fail"):
        raise SystemExit(f"{done['checks']['fail']} checks failed")


if __name__ == "__main__":
    main()
