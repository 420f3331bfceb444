"""The three daily reports, declared once and used by batch and stream alike."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RSD = 0.05

# Of a sketch: 2^12 places, a standard error of 1.6 %.
SKETCH_BITS = 12

# Standard errors that an estimate may be off, so that none of millions of groups is.
ERRORS = 6


@dataclass(frozen=True)
class Measure:
    """``users`` counts distinct values of ``source``; ``sum`` adds them up; ``sketch`` holds
    the distinct values in a form that can be united over keys and then counted."""

    name: str
    kind: str
    source: str
    type: T.DataType

    def expression(self, exact: bool) -> Column:
        if self.kind == "users":
            count = F.count_distinct(self.source) if exact else F.approx_count_distinct(self.source, RSD)
            return count.alias(self.name)
        if self.kind == "sketch":
            return F.hll_sketch_agg(self.source, SKETCH_BITS).alias(self.name)
        return F.sum(self.source).alias(self.name)


@dataclass(frozen=True)
class Report:
    """``keys`` maps each grouping column to its type in the finished report."""

    name: str
    keys: tuple[tuple[str, T.DataType], ...]
    measures: tuple[Measure, ...]

    @property
    def key_names(self) -> list[str]:
        return [name for name, _ in self.keys]

    @property
    def measure_names(self) -> list[str]:
        return [m.name for m in self.measures]

    @property
    def columns(self) -> list[str]:
        return self.key_names + self.measure_names

    @property
    def inputs(self) -> list[str]:
        """Record columns this report reads; nothing else need be scanned."""
        return list(dict.fromkeys(self.key_names + [m.source for m in self.measures]))

    @property
    def schema(self) -> T.StructType:
        """Types of the finished report."""
        fields = [T.StructField(n, t) for n, t in self.keys]
        return T.StructType(fields + [T.StructField(m.name, m.type) for m in self.measures])

    @property
    def message_schema(self) -> T.StructType:
        """Types when read back from the changelog: the date, and text for the rest."""
        return T.StructType(
            [T.StructField(f.name, T.DateType() if f.name == "ts_date" else T.StringType()) for f in self.schema]
        )

    @property
    def keys_may_merge(self) -> bool:
        """Keys that are text in the stream but numbers here: two texts can be one number."""
        return any(isinstance(t, T.DoubleType) for _, t in self.keys)

    def aggregate(self, records: DataFrame, exact: bool = False, *more: Column) -> DataFrame:
        """Group and total. Every aggregate has a map-side part, so a day that holds a
        third of all rows still sends only its partial results through the shuffle.

        ``exact`` counts users exactly; Spark then first reduces to (key, user) pairs,
        spread by both. A stream cannot do that and keeps the estimate. ``more`` are
        aggregates beside the report's own.
        """
        return records.groupBy(*self.key_names).agg(*[m.expression(exact) for m in self.measures], *more)


def _users() -> Measure:
    return Measure("daily_pu", "users", "customer_id", T.LongType())


def _sums(*pairs: tuple[str, str]) -> tuple[Measure, ...]:
    return tuple(
        Measure(name, "sum", source, T.LongType() if source == "quantity" else T.DoubleType())
        for name, source in pairs
    )


DAILY_PU_REV = Report(
    "daily_pu_rev",
    (("ts_date", T.DateType()),),
    (_users(), *_sums(("daily_rev", "revenue"), ("daily_profit", "profit"))),
)

DAILY_CATEGORY_PRODUCT = Report(
    "daily_category_product",
    (
        ("ts_date", T.DateType()),
        ("category", T.StringType()),
        ("sub_category", T.StringType()),
        ("product_name", T.StringType()),
    ),
    _sums(("daily_quantity", "quantity"), ("daily_rev", "revenue"), ("daily_profit", "profit")),
)

DAILY_ADDRESS = Report(
    "daily_address",
    (("ts_date", T.DateType()), ("latitude", T.DoubleType()), ("longitude", T.DoubleType())),
    (_users(),),
)

REPORTS = {r.name: r for r in (DAILY_PU_REV, DAILY_CATEGORY_PRODUCT, DAILY_ADDRESS)}

#: The customers of a day and country, from which those of any days and countries follow:
#: numbers of users, unlike money, cannot be added up.
DAILY_USERS = Report(
    "daily_users",
    (("ts_date", T.DateType()), ("country", T.StringType())),
    (Measure("users", "sketch", "customer_id", T.BinaryType()),),
)

ALL_REPORTS = {**REPORTS, DAILY_USERS.name: DAILY_USERS}


def users_with_bound(records: DataFrame, keys: list[str], user: str = "customer_id") -> DataFrame:
    """Exact and estimated users per key, and whether the estimate is close enough.

    Both come from the distinct (key, user) pairs: repeats do not change either
    number, and the estimator's 416-byte buffer is kept per key, not per pair.
    """
    pairs = records.select(*keys, user).distinct()
    counted = pairs.groupBy(*keys).agg(
        F.count(user).alias("daily_pu"), F.approx_count_distinct(user, RSD).alias("estimate")
    )
    return counted.select(*keys, "daily_pu", within_bound(F.col("estimate"), F.col("daily_pu")).alias("pu_in_bound"))


def within_bound(estimate: Column, exact: Column) -> Column:
    """Whether the estimate is near enough: ERRORS standard errors and two users."""
    return F.abs(estimate - exact) <= F.lit(2) + F.lit(ERRORS * RSD) * exact


def users_over(daily_users: DataFrame, *keys: Column) -> DataFrame:
    """Estimated distinct users of each group of days and countries, from their sketches:
    ``keys`` and ``users``. Tasks unite sketches first, of a few kilobytes each."""
    return daily_users.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


def roll_up(report_rows: DataFrame, key: str, measure: str, alias: str) -> DataFrame:
    """Total a finished report over all but one of its keys."""
    return report_rows.groupBy(key).agg(F.sum(measure).alias(alias))
