"""Reports over the marts and over the incident (bird-strike) tables.

Every report pre-aggregates the fact side on its join key before joining the
next table, so a flight, airline or state that holds a large share of the rows
is collapsed by map-side partial aggregation instead of being shuffled whole.
Top-k reports use ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject (per-partition top-k, then a k-row merge); ties are
broken by the group key so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


# ------------------------------------------------------------ sales reports

def top_reps(rep_facts: DataFrame, k: int = 5) -> DataFrame:
    """M9: five best reps by units (total_sold), from the rep_facts mart.

    The source groups by rid and selects bare fname, lname, total_sold, all
    constant per rid (reps has one row per rid), so they join the grouping
    key and total_sold is taken with ``max`` (a hash aggregate; no string
    aggregation buffers).
    """
    per_rep = (rep_facts.groupBy("rid", "fname", "lname")
               .agg(F.max("total_sold").alias("units")))
    return (per_rep.where(F.col("units").isNotNull())
            .orderBy(F.desc("units"), F.asc("rid")).limit(k)
            .select("fname", "lname", "units"))


def month_levels(prod_month: DataFrame) -> DataFrame:
    """Month labels ranked by first appearance in prod_month.

    prod_month rows come in (pname, month) order, so a month first appears at
    the smallest pname that has it; levels are ranked by (that pname, month).
    The set of months is small (one per calendar month in the data); the
    ranking window runs over that set only.
    """
    first = (prod_month.where(F.col("month").isNotNull())
             .groupBy("month").agg(F.min("pname").alias("first_pname")))
    w = Window.orderBy(F.col("first_pname").asc_nulls_first(), F.col("month"))
    return first.select("month", F.row_number().over(w).alias("level"))


def month_total(prod_month: DataFrame) -> DataFrame:
    """Stacked-bar height per month = sum over products."""
    return (prod_month.groupBy("month")
            .agg(F.sum("total_sold_per_month").alias("total_sold")))


# --------------------------------------------------------- incident reports

def _strike_count(count_col: str | None) -> Column:
    return F.count(count_col) if count_col else F.count(F.lit(1))


def strikes_per_flight(strikes: DataFrame, count_col: str | None = None) -> DataFrame:
    """Pre-aggregate strikes per flight: fid -> n (COUNT(sid)), birds."""
    return strikes.groupBy("fid").agg(_strike_count(count_col).alias("n"),
                                      F.sum("numbirds").alias("birds"))


def strikes_by_state(strikes: DataFrame, flights: DataFrame, airports: DataFrame,
                     k: int = 10, count_col: str | None = None) -> DataFrame:
    """A8 + O2: strike count per airport state, top 10 (ties by state)."""
    per_flight = strikes_per_flight(strikes, count_col)
    per_origin = (per_flight.join(flights.select("fid", "origin"), "fid")
                  .groupBy("origin").agg(F.sum("n").alias("n")))
    per_state = (per_origin.join(airports, per_origin.origin == airports.aid)
                 .groupBy("airportState").agg(F.sum("n").alias("strikCount")))
    return (per_state.orderBy(F.desc("strikCount"), F.asc_nulls_last("airportState"))
            .limit(k).select("strikCount", "airportState"))


def strikes_per_airline(strikes: DataFrame, flights: DataFrame,
                        count_col: str | None = None) -> DataFrame:
    per_flight = strikes_per_flight(strikes, count_col)
    return (per_flight.join(flights.select("fid", "airline"), "fid")
            .groupBy("airline").agg(F.sum("n").alias("strikCount")))


def avg_strikes_per_airline(strikes: DataFrame, flights: DataFrame,
                            count_col: str | None = None) -> DataFrame:
    """A10: average of the per-airline strike counts (one row)."""
    return (strikes_per_airline(strikes, flights, count_col)
            .agg(F.avg("strikCount").alias("avStrikeCount")))


def above_avg_airlines(strikes: DataFrame, flights: DataFrame,
                       count_col: str | None = None) -> DataFrame:
    """Airlines whose strike count is above the per-airline average.

    The average is an uncorrelated scalar subquery over the same grouped
    DataFrame, evaluated once; no cross join.
    """
    counts = strikes_per_airline(strikes, flights, count_col)
    avg = counts.select(F.avg("strikCount")).scalar()
    return counts.where(F.col("strikCount") > avg).select("strikCount", "airline")


def strikes_by_month(strikes: DataFrame, flights: DataFrame) -> DataFrame:
    """SUM(numbirds) by month of year '01'..'12' (null date -> null month)."""
    per_flight = strikes.groupBy("fid").agg(F.sum("numbirds").alias("birds"))
    return (per_flight.join(flights.select("fid", "date"), "fid")
            .groupBy(F.date_format("date", "MM").alias("month"))
            .agg(F.sum("birds").alias("birds"))
            .select("birds", "month"))


def preview(df: DataFrame, key: str | list[str], n: int = 5) -> DataFrame:
    """O3: the first ``n`` rows by key (the source's unordered ``LIMIT n``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)
