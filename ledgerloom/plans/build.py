"""The whole chain: raw orders to staged tables, facts and dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.checks.suite import DECLARED, FURTHER, ON_LOOKUPS, Check, on_whole_tables, run_suite
from ledgerloom.operators.stored import store
from ledgerloom.plans import dates, descriptions, intermediate, marts, staging
from ledgerloom.sources.tables import ensure_database, save_table, save_view


#: The models that may be checked, each a property of the class below.
MODELS = tuple(dict.fromkeys(c.table for c in DECLARED if c.table != "raw_orders"))


class Models:
    """The models over one raw table, each a lazy DataFrame over the ones before it.

    ``keep`` decides what becomes of a model that others read: it gets the DataFrame and
    its name, and returns what the readers see. Staged tables and facts are read several
    times and are worth keeping; the two intermediate models stay views.
    """

    def __init__(
        self, raw: DataFrame, as_of: dt.date | str | None = None,
        keep: Callable[[DataFrame, str], DataFrame] = store,
        calendar: tuple[str, str] = (dates.FIRST_DAY, dates.LAST_DAY),
    ):
        self.raw, self.as_of, self._keep, self.calendar = raw, as_of, keep, calendar

    def once(self, name: str) -> DataFrame:
        """A staged model or the order fact for one reading: as kept if it is kept already, else its plan, of which only
        the columns that are read go through the shuffles."""
        if name in self.__dict__:
            return getattr(self, name)
        return marts.fct_orders(self.int_orders_enriched) if name == "fct_orders" else getattr(staging, name)(self.raw)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._keep(staging.stg_orders(self.raw), "stg_orders")

    @cached_property
    def stg_line_items(self) -> DataFrame:
        return self._keep(staging.stg_line_items(self.raw), "stg_line_items")

    @cached_property
    def stg_fulfillments(self) -> DataFrame:
        return self._keep(staging.stg_fulfillments(self.raw), "stg_fulfillments")

    @property
    def int_orders_enriched(self) -> DataFrame:
        # children are read once here, whether or not others read them as well
        return intermediate.orders_enriched(*map(self.once, BUCKETED))

    @cached_property
    def int_customer_history(self) -> DataFrame:
        return intermediate.customer_history(self.stg_orders, self.as_of)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._keep(marts.fct_orders(self.int_orders_enriched), "fct_orders")

    @cached_property
    def fct_daily_revenue(self) -> DataFrame:
        return self._keep(marts.fct_daily_revenue(self.fct_orders), "fct_daily_revenue")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._keep(marts.dim_customers(self.int_customer_history), "dim_customers")

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._keep(marts.dim_products(self.stg_line_items, self.as_of), "dim_products")

    @cached_property
    def dim_dates(self) -> DataFrame:
        """The days of ``calendar``, and all others from the first order to the last."""
        spine = dates.spine_covering(self.once("stg_orders"), "order_created_at", *self.calendar)
        return self._keep(dates.dim_dates(spine, self.as_of), "dim_dates")

    def tables(self, checks: Iterable[Check] = DECLARED) -> dict[str, DataFrame]:
        """The models that ``checks`` look at, by name; no others are built for them.

        The two views have the rows of the fact and the dimension that are made of them
        one to one, and their checked columns unchanged; those are read in their place.
        """
        stored = {"int_orders_enriched": "fct_orders", "int_customer_history": "dim_customers"}
        looked_at = {t for c in checks for t in (c.table, c.args.get("to"))}
        names = [n for n in MODELS if n in looked_at]
        wanted = dict.fromkeys(stored.get(n, n) for n in names)
        for staged in BUCKETED:
            # what several of them read is kept before the first of them is built
            if sum(staged == n or staged in READS.get(n, ()) for n in wanted) > 1:
                getattr(self, staged)
        return {"raw_orders": self.raw, **{n: getattr(self, stored.get(n, n)) for n in names}}

    def check(self, further: bool = False, lookups: Mapping[str, DataFrame] | None = None, at: str | None = None) -> DataFrame:
        """The declared checks; with ``further`` the further ones too, and those on the lookup tables given; with ``at``,
        a time, those on whole tables, as of then."""
        checks = [*DECLARED, *(FURTHER if further else ()), *(c for c in ON_LOOKUPS if c.table in (lookups or {}))]
        checks += on_whole_tables(at) if at else ()
        return run_suite(checks, {**self.tables(checks), **(lookups or {})})


#: The staged models that a model is built from.
READS = {"fct_orders": ("stg_orders", "stg_line_items", "stg_fulfillments"), "dim_customers": ("stg_orders",), "dim_products": ("stg_line_items",)}
# Staged tables share this column, so bucketing by it makes their joins local.
BUCKET_COLUMN = "order_id"
BUCKETED = ("stg_orders", "stg_line_items", "stg_fulfillments")
# Facts that are read by date are stored by month.
PARTITIONED = {"fct_orders": ("order_year", "order_month")}


def saver(
    spark: SparkSession, staging_db: str, marts_db: str, buckets: int | None = None, staged_as_views: bool = False
) -> Callable[[DataFrame, str], DataFrame]:
    """Saves a model as a table of its database, with its description, buckets and partitions, and returns a scan of it."""
    def keep(df: DataFrame, name: str) -> DataFrame:
        staged = name.startswith("stg_")
        if staged and staged_as_views:
            save_view(df, name)
            return df
        full = f"`{staging_db if staged else marts_db}`.`{name}`"
        about = descriptions.MODELS.get(name, {})
        save_table(
            df, full, bucket_by=(buckets, BUCKET_COLUMN) if buckets and name in BUCKETED else None,
            partition_by=PARTITIONED.get(name, ()),
            description=about.get("description"), columns=about.get("columns"),
            properties=about.get("properties"),
        )
        return spark.table(full)

    return keep


def build_all(
    raw: DataFrame, as_of: dt.date | str | None, keep: Callable[[DataFrame, str], DataFrame], calendar: tuple[str, str]
) -> Models:
    """Every model that is kept, built."""
    models = Models(raw, as_of, keep, calendar)
    models.tables()
    models.dim_dates  # noqa: B018 - built on access
    return models


def build(
    spark: SparkSession, raw: DataFrame, database: str, as_of: dt.date | str | None = None,
    buckets: int | None = None, staged_as_views: bool = False,
    calendar: tuple[str, str] = (dates.FIRST_DAY, dates.LAST_DAY),
) -> Models:
    """Rebuild all kept models, staged ones in ``<database>_staging``, the others in ``<database>_marts``.

    With ``buckets`` the staged tables are stored hashed by order, and the joins
    and aggregates that enrich orders run without a shuffle. Choose it so that one
    bucket of line items fits a task. The order fact is stored by month, so that a range
    of dates reads its months only. ``staged_as_views`` publishes the staged models as
    views instead: nothing is stored, and every reader computes them again.

    Tables are replaced in place, one by one; ``release`` rebuilds them beside the ones in use.
    """
    places = f"{database}_staging", f"{database}_marts"
    for place in places:
        ensure_database(spark, place)
    return build_all(raw, as_of, saver(spark, *places, buckets, staged_as_views), calendar)
