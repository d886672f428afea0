"""The business queries, over any tables that have the needed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions import clean


def mean(value: str) -> Column:
    """Mean of the values there are, to two digits; sums of decimals are exact."""
    return F.round(F.sum(value).cast("double") / F.count(value), 2)


def by_group(df: DataFrame, key: str, value: str, count: str = "lead_count", average: str = "avg_budget") -> DataFrame:
    """Rows and mean value per group, most rows first."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count), mean(value).alias(average)).orderBy(F.desc(count), key)


def flags_by_group(df: DataFrame, key: str, flags: dict[str, Column], count: str = "lead_count") -> DataFrame:
    counted = [F.count_if(c).alias(n) for n, c in flags.items()]
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count), *counted).orderBy(F.desc(count), key)


def monthly(df: DataFrame, at: str, count: str = "new_leads") -> DataFrame:
    parts = [F.year(at).alias("year"), F.month(at).alias("month")]
    return df.where(F.col(at).isNotNull()).groupBy(*parts).agg(F.count(F.lit(1)).alias(count)).orderBy("year", "month")


def top_with_variety(df: DataFrame, key: str, variety: str, n: int, count: str, distinct: str) -> DataFrame:
    """Largest groups with the number of distinct values of another column."""
    df = df.where(clean.not_blank(F.col(key)))
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias(count), F.count_distinct(F.col(variety)).alias(distinct))
    return out.orderBy(F.desc(count), key).limit(n)


def value_summary(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    return df.where(v.isNotNull()).agg(
        F.count(F.lit(1)).alias("total_sales"),
        F.sum(v).alias("total_revenue"),
        F.avg(v).alias("avg_sale"),
        F.min(v).alias("min_sale"),
        F.max(v).alias("max_sale"),
    )


def value_by_group(df: DataFrame, key: str, value: str) -> DataFrame:
    df = df.where(F.col(key).isNotNull())
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("sale_count"), F.sum(value).alias("total_value")).orderBy(F.desc("total_value"), key)


def conversion(leads: DataFrame, sales: DataFrame, lead_key: str, sale_key: str, source: str, more_than: int = 10) -> DataFrame:
    """Leads and converted leads per source.

    Sales are reduced to their distinct lead keys before the join, so a lead
    with many sales is one row and the two distinct counts are plain counts
    after one grouping by lead.
    """
    bought = sales.select(F.col(sale_key).alias("_k")).where("_k is not null").distinct()
    one = leads.where(F.col(lead_key).isNotNull()).select(source, lead_key).distinct()
    out = one.join(bought, F.col(lead_key) == F.col("_k"), "left").groupBy(source)
    out = out.agg(F.count(F.lit(1)).alias("total_leads"), F.count("_k").alias("converted_leads")).where(F.col("total_leads") > more_than)
    rate = clean.percent(F.col("converted_leads"), F.col("total_leads"))
    return out.withColumn("conversion_rate_pct", rate).orderBy(F.desc("conversion_rate_pct"), source)


def agents(df: DataFrame, agent: str, won: Column, value: str, n: int = 20, average: str = "avg_budget") -> DataFrame:
    """Leads, conversions, mean value and rate of the busiest agents."""
    out = df.where(F.col(agent).isNotNull()).groupBy(F.col(agent).alias("agent_id"))
    out = out.agg(F.count(F.lit(1)).alias("leads_handled"), F.count_if(won).alias("converted"), mean(value).alias(average))
    out = out.withColumn("conversion_rate", clean.percent(F.col("converted"), F.col("leads_handled")))
    return out.orderBy(F.desc("leads_handled"), "agent_id").limit(n)


def segments(df: DataFrame, buyer: Column, seller: Column, value: str) -> DataFrame:
    kind = F.when(buyer & seller, "Both").when(buyer, "Buyer").when(seller, "Seller").otherwise("Unknown")
    out = df.groupBy(kind.alias("segment")).agg(F.count(F.lit(1)).alias("lead_count"), F.round(F.avg(value), 2).alias("avg_budget"))
    return out.orderBy(F.desc("lead_count"), "segment")


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of every table."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def date_slice(dates: DataFrame, first: str, last: str, n: int = 10) -> DataFrame:
    return dates.where(F.col("date_actual").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).orderBy("date_actual").limit(n)


def decorated(fact: DataFrame, dims: list[tuple[DataFrame, str]], columns: list[str], order: str, n: int | None = None) -> DataFrame:
    """Fact rows with the attributes of their dimensions (left joins; Spark
    broadcasts the dimensions whose size allows it)."""
    for dim, key in dims:
        fact = fact.join(dim, key, "left")
    out = fact.select(*columns)
    return out if n is None else out.orderBy(order).limit(n)


def versions(dim: DataFrame, key: str, effective: str = "effective_from") -> DataFrame:
    """Full history of the keys with several versions."""
    many = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    return dim.join(many, key, "left_semi").orderBy(key, effective)


def null_analysis(df: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *nulls).select(F.lit(dataset).alias("dataset"), "*")


def duplicates(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrence")).where("occurrence > 1")
    return out.orderBy(F.desc("occurrence"), *keys).limit(n)


def load_history(log: DataFrame, n: int = 20) -> DataFrame:
    return log.orderBy(F.desc("end_time"), "table_name").limit(n)


def counts_by_member(fact: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    return fact.join(dim, key).groupBy(name).agg(F.count(F.lit(1)).alias("lead_count"))


def revenue_by_month(fact: DataFrame, dates: DataFrame, key: str, value: str) -> DataFrame:
    out = fact.join(dates, key).groupBy("year", "month", "month_name")
    return out.agg(F.count(F.lit(1)).alias("sale_count"), F.sum(value).alias("revenue")).orderBy("year", "month")
