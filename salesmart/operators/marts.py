"""The profit mart, its roll-ups, top-k forms and catalogue summaries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MART_KEYS = ("Year", "Category", "SubCategory", "CustomerName")


def exact_total(name: str) -> str:
    """SQL of the sum of the double column ``name``, half up to cents, free of the order of rows.

    Values add up as decimals of six places, so a total does not depend on
    partitions, retries or merge order.  If a value has no such decimal (not
    finite, or 1e22 and above) or the sum outgrows 38 digits, the total is
    that of the doubles.
    """
    exact = f"try_cast({name} AS DECIMAL(28, 6))"
    return (f"coalesce(CASE WHEN count({name}) = count({exact}) "
            f"THEN CAST(round(try_sum({exact}), 2) AS DOUBLE) END, round(sum({name}), 2))")


def aggregate_profit_by(enriched: DataFrame) -> DataFrame:
    """Total rounded profit per year, category, sub-category and customer
    name (null keys form their own groups; customers sharing a name merge)."""
    return (enriched.groupBy(*MART_KEYS)
            .agg(F.expr(exact_total("ProfitRounded")).alias("TotalProfit")))


def _rollup(agg: DataFrame, keys: list[str], name: str) -> DataFrame:
    return agg.groupBy(*keys).agg(F.expr(exact_total("TotalProfit")).alias(name))


def profit_by_year(agg: DataFrame) -> DataFrame:
    return _rollup(agg, ["Year"], "ProfitByYear").orderBy("Year")


def profit_by_year_category(agg: DataFrame) -> DataFrame:
    return (_rollup(agg, ["Year", "Category"], "ProfitByYearCategory")
            .orderBy("Year", "Category"))


def profit_by_customer(agg: DataFrame) -> DataFrame:
    """Highest profit first; equal profits by name."""
    return (_rollup(agg, ["CustomerName"], "ProfitByCustomer")
            .orderBy(F.desc("ProfitByCustomer"), F.asc("CustomerName")))


def profit_by_customer_year(agg: DataFrame) -> DataFrame:
    """Year ascending, then name descending."""
    return (_rollup(agg, ["CustomerName", "Year"], "ProfitByCustomerYear")
            .orderBy(F.asc("Year"), F.desc("CustomerName")))


def first_rows(sorted_df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of a sorted result (planned as a top-k)."""
    return sorted_df.limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """``n`` rows of a table for display: the first ``n`` by all columns in
    column order (nulls first), so the sample is the same on every run."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)


_TOTAL = exact_total("TotalProfit")

# The same roll-ups as SQL text over the temp view ``aggregates``.
ROLLUP_SQL = {
    "profit_by_year": f"""
        SELECT Year, {_TOTAL} AS ProfitByYear
        FROM aggregates GROUP BY Year ORDER BY Year""",
    "profit_by_year_category": f"""
        SELECT Year, Category, {_TOTAL} AS ProfitByYearCategory
        FROM aggregates GROUP BY Year, Category ORDER BY Year, Category""",
    "profit_by_customer": f"""
        SELECT CustomerName, {_TOTAL} AS ProfitByCustomer
        FROM aggregates GROUP BY CustomerName
        ORDER BY ProfitByCustomer DESC, CustomerName""",
    "profit_by_customer_year": f"""
        SELECT CustomerName, Year, {_TOTAL} AS ProfitByCustomerYear
        FROM aggregates GROUP BY CustomerName, Year
        ORDER BY Year, CustomerName DESC""",
}


def register_aggregates(agg: DataFrame, view: str = "aggregates") -> None:
    agg.createOrReplaceTempView(view)


def rollup_sql(spark: SparkSession, name: str, agg: DataFrame | None = None) -> DataFrame:
    """Run one of ``ROLLUP_SQL`` against the ``aggregates`` view (registered
    from ``agg`` first when given)."""
    if agg is not None:
        register_aggregates(agg)
    return spark.sql(ROLLUP_SQL[name])


def issue_summary(issue_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per (table, issue code) over all issue tables."""
    parts = [df.select(F.lit(name).alias("table_name"), F.explode("Issues").alias("issue"))
             for name, df in issue_tables.items()]
    return (reduce(DataFrame.unionByName, parts)
            .groupBy("table_name", "issue").agg(F.count(F.lit(1)).alias("row_count")))


def table_counts(catalog: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table of a catalogue, in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in catalog.items()]
    return reduce(DataFrame.unionByName, parts)
