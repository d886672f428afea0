"""Column profiles and quality dimensions in one pass over the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.functions import clean
from tarnlake.session import materialize

NUMERIC = (T.NumericType, T.BooleanType)
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _kind(t: T.DataType) -> str:
    return "numeric" if isinstance(t, NUMERIC) else "datetime" if isinstance(t, TIMES) else "string" if isinstance(t, T.StringType) else "other"


def _long(row: DataFrame, columns: list[str], metrics: list[str]) -> DataFrame:
    """One wide aggregate row to (column_name, metric...) rows."""
    parts = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{m}|{c}`").alias(m) for m in metrics]) for c in columns]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, distinct_count): exact, for any number of columns.

    Values are unpivoted as text with their column and grouped twice. The rows
    are not multiplied inside one aggregate's buffers, partial aggregation
    folds repeats before the shuffle, and one column's values spread over all
    tasks.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]))
    values = df.select(pairs.alias("p")).select("p.*").where("v is not null")
    return values.groupBy("column_name", "v").agg(F.lit(1)).groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))


def completeness_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """column_name, row_count, null_count, null_pct, distinct_count,
    distinct_pct, duplicate_count for every column."""
    aggs: list[Column] = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        aggs += [F.count(F.lit(1)).alias(f"row_count|{c}"), F.count_if(col.isNull()).alias(f"null_count|{c}")]
        if approximate:
            aggs.append(F.approx_count_distinct(col).alias(f"distinct_count|{c}"))
    base = _long(df.agg(*aggs), df.columns, ["row_count", "null_count"] + ["distinct_count"] * approximate)
    if not approximate:
        base = base.join(distinct_counts(df, df.columns), "column_name", "left").withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))
    filled = F.col("row_count") - F.col("null_count")
    return base.select(
        "column_name",
        "row_count",
        "null_count",
        F.coalesce(clean.percent(F.col("null_count"), F.col("row_count")), F.lit(0.0)).alias("null_pct"),
        "distinct_count",
        F.coalesce(clean.percent(F.col("distinct_count"), filled), F.lit(0.0)).alias("distinct_pct"),
        (filled - F.col("distinct_count")).alias("duplicate_count"),
    )


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """(column_name, quantiles): exact, interpolated between neighbours.

    Values are counted, range-sorted over (column, value) and ranked by running
    sums with one offset per partition, so no task holds a column. NULLs are
    left out; a column without values has NULL quantiles.
    """
    spread = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])).alias("r"))
    counts = spread.select("r.*").where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    dealt = counts.repartitionByRange("column_name", "value").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "values")
    sums = dealt.groupBy("column_name", "part").agg(F.sum("n").alias("s"))
    before = W.partitionBy("column_name").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    whole = F.sum("s").over(W.partitionBy("column_name"))
    shift = sums.select("column_name", "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("shift"), whole.alias("total"))
    running = F.sum("n").over(W.partitionBy("column_name", "part").orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    ranked = dealt.withColumn("upto", running).join(shift, ["column_name", "part"]).withColumn("upto", F.col("upto") + F.col("shift"))
    ends = []
    for i, p in enumerate(shares):
        at = (F.col("total") - 1) * F.lit(float(p))
        for name, rank in (("low", F.floor(at)), ("high", F.ceil(at))):
            ends.append(F.max(F.when((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n")), F.col("value"))).alias(f"{name}{i}"))
    found = ranked.groupBy("column_name").agg(F.max("total").alias("total"), *ends)
    parts = []
    for i, p in enumerate(shares):
        at = (F.col("total") - 1) * F.lit(float(p))
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        parts.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high))
    named = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return named.join(found.select("column_name", F.array(*parts).alias("quantiles")), "column_name", "left")


def numeric_profile(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """min, max, mean, std (sample; 0 for one value), median, sum, zero,
    negative and positive counts. Booleans count as 0 and 1."""
    middle = {} if approximate else {r.column_name: r.quantiles for r in quantiles(df, columns, [0.5]).collect()}
    aggs = []
    for c in columns:
        x = F.col(f"`{c}`").cast("double")
        median = F.approx_percentile(x, F.lit(0.5)) if approximate else F.max(F.lit((middle[c] or [None])[0]).cast("double"))
        std = F.when(F.count(x) == 1, 0.0).otherwise(F.stddev_samp(x))
        made = {
            "min": F.min(x), "max": F.max(x), "mean": F.avg(x), "std": std, "median": median, "sum": F.sum(x),
            "zeros": F.count_if(x == 0), "negatives": F.count_if(x < 0), "positives": F.count_if(x > 0),
        }
        aggs += [v.alias(f"{k}|{c}") for k, v in made.items()]
    return _long(df.agg(*aggs), columns, ["min", "max", "mean", "std", "median", "sum", "zeros", "negatives", "positives"])


def iqr_outliers(df: DataFrame, columns: list[str], approximate: bool = False, reach: float = 1.5) -> DataFrame:
    """Quartiles, fences and the number of values outside, by column.

    Two passes: the quartiles (two numbers a column) go into the second.
    """
    x = {c: F.col(f"`{c}`").cast("double") for c in columns}
    if approximate:
        quarts = df.agg(*[F.approx_percentile(v, F.array(F.lit(0.25), F.lit(0.75))).alias(c) for c, v in x.items()]).first()
    else:
        quarts = {r.column_name: r.quantiles for r in quantiles(df, columns, [0.25, 0.75]).collect()}
    aggs, fences = [], {}
    for c, v in x.items():
        q1, q3 = quarts[c] or (None, None)
        if q1 is None:
            low = high = None
        else:
            low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
        fences[c] = q1, q3, low, high
        aggs.append(F.count_if((v < F.lit(low)) | (v > F.lit(high))).alias(c))
    row = df.agg(*aggs)
    kinds = "struct<q1:double,q3:double,low:double,high:double>"
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.struct(*[F.lit(f) for f in fences[c]]).cast(kinds).alias("f"), F.col(f"`{c}`").alias("outliers"))
        for c in columns
    ]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.column_name", "r.f.*", "r.outliers")


def datetime_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """First and last instant and the whole days between."""
    aggs = []
    for c in columns:
        x = F.col(f"`{c}`").cast("timestamp_ntz")
        days = F.floor(clean.seconds_between(F.min(x), F.max(x)) / 86400)
        aggs += [F.min(x).alias(f"min|{c}"), F.max(x).alias(f"max|{c}"), days.alias(f"range_days|{c}")]
    return _long(df.agg(*aggs), columns, ["min", "max", "range_days"])


def string_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lengths, empty texts and JSON-like texts by column."""
    aggs = []
    for c in columns:
        x = F.col(f"`{c}`")
        made = {
            "min_length": F.min(F.length(x)),
            "max_length": F.max(F.length(x)),
            "avg_length": F.round(F.avg(F.length(x)), 2),
            "empty_count": F.count_if(clean.strip(x) == ""),
            "json_count": F.count_if(clean.looks_like_json(x)),
        }
        aggs += [v.alias(f"{k}|{c}") for k, v in made.items()]
    return _long(df.agg(*aggs), columns, ["min_length", "max_length", "avg_length", "empty_count", "json_count"])


def top_values(df: DataFrame, columns: list[str], n: int = 10, width: int = 100) -> DataFrame:
    """The n commonest values by column with count and share of non-nulls."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    counts = df.select(pairs.alias("p")).select("p.*").where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"total|{c}") for c in columns])
    w = W.partitionBy("column_name").orderBy(F.desc("n"), "value")
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    top = top.join(F.broadcast(_long(totals, columns, ["total"])), "column_name")  # one row per column
    return top.select("column_name", "rank", F.substring("value", 1, width).alias("value"), "n", clean.percent(F.col("n"), F.col("total")).alias("pct"))


def profile_table(df: DataFrame, name: str, approximate: bool = False) -> dict[str, DataFrame]:
    """All profiles of a table, by kind of column."""
    kinds = {c.name: _kind(c.dataType) for c in df.schema}
    of = lambda k: [c for c, v in kinds.items() if v == k]
    out = {"columns": completeness_profile(df, approximate).withColumn("table_name", F.lit(name))}
    if of("numeric"):
        out["numeric"] = numeric_profile(df, of("numeric"), approximate)
        out["outliers"] = iqr_outliers(df, of("numeric"), approximate)
    if of("datetime"):
        out["datetime"] = datetime_profile(df, of("datetime"))
    if of("string"):
        out["string"] = string_profile(df, of("string"))
        out["top"] = top_values(df, of("string"))
    return out


def profile_all(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, the column profile): every table in name order. A table
    that cannot be read has one row with its error and no columns."""
    rows, failed = [], []
    for name, df in sorted(tables.items()):
        try:
            rows.append(materialize(completeness_profile(df).withColumn("table_name", F.lit(name)), "profile"))
        except Exception as e:  # reported in the row of this table
            failed.append((name, str(e).splitlines()[0]))
    out = [r.withColumn("error", F.lit(None).cast("string")) for r in rows]
    if failed:
        spark = next(iter(tables.values())).sparkSession
        out.append(spark.createDataFrame(failed, "table_name string, error string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def profile_summary(columns: DataFrame, outliers: DataFrame | None = None) -> DataFrame:
    """Null share, columns with nulls, duplicates and outliers, completeness."""
    cells, nulls = F.sum("row_count"), F.sum("null_count")
    out = columns.agg(
        F.coalesce(clean.percent(nulls, cells), F.lit(0.0)).alias("null_cell_pct"),
        F.count_if(F.col("null_count") > 0).alias("columns_with_nulls"),
        F.count_if(F.col("duplicate_count") > 0).alias("columns_with_duplicates"),
        (100 - F.coalesce(clean.percent(nulls, cells), F.lit(0.0))).alias("completeness"),
    )
    found = outliers.where("outliers > 0").agg(F.count(F.lit(1))).first()[0] if outliers is not None else 0
    return out.withColumn("columns_with_outliers", F.lit(found).cast("long"))


def profile_drift(old: DataFrame, new: DataFrame, metrics: list[str]) -> DataFrame:
    """Two profiles side by side: (column_name, metric, old, new, change)."""
    spread = lambda df, v: df.unpivot(["column_name"], [F.col(m).cast("double").alias(m) for m in metrics], "metric", v)
    both = spread(old, "old").join(spread(new, "new"), ["column_name", "metric"], "full")
    return both.withColumn("change", F.col("new") - F.col("old"))


# Quality dimensions. Weights and freshness steps.
WEIGHTS = {"completeness": 0.30, "uniqueness": 0.25, "validity": 0.25, "timeliness": 0.20}
TIME_COLUMNS = ("updated_at", "created_at", "extraction_time", "date_of_last_request")


def completeness(df: DataFrame) -> DataFrame:
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns])
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(F.coalesce(F.round((1 - nulls / F.nullif(cells, F.lit(0))) * 100, 2), F.lit(100.0)).alias("completeness"))


def uniqueness(df: DataFrame) -> DataFrame:
    """Mean over columns of distinct / non-null * 100."""
    p = completeness_profile(df)
    rate = F.when(F.col("row_count") == F.col("null_count"), 100.0).otherwise(F.col("distinct_pct"))
    return p.agg(F.round(F.avg(rate), 2).alias("uniqueness"))


def validity(df: DataFrame) -> DataFrame:
    """Mean over text columns of 100 - JSON blobs / non-null * 50; 100 without any."""
    cols = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([(100.0,)], "validity double")
    rates = []
    for c in cols:
        x = F.col(f"`{c}`")
        rates.append(F.round(F.coalesce(100 - F.count_if(clean.is_json_blob(x)) / F.nullif(F.count(x), F.lit(0)) * 50, F.lit(100.0)), 2))
    return df.agg(F.round(reduce(lambda a, b: a + b, rates) / len(rates), 2).alias("validity"))


def timeliness(df: DataFrame, as_of: str, columns: tuple[str, ...] = TIME_COLUMNS) -> DataFrame:
    """100 up to a day, 80 up to two, 60 up to three, then two points an hour
    from the first day on; 100 without a usable time column."""
    ages = []
    for c in columns:
        if c in df.columns:
            t = F.col(c)
            t = clean.parse_timestamp(t) if dict(df.dtypes)[c] == "string" else t
            ages.append(clean.seconds_between(F.max(t.cast("timestamp_ntz")), F.lit(as_of)) / 3600)
    if not ages:
        return df.sparkSession.createDataFrame([(100.0,)], "timeliness double")
    row = df.agg(F.coalesce(*ages).alias("h"))
    late = F.greatest(F.lit(0.0), 100 - (F.col("h") - 24) * 2)
    score = F.when(F.col("h").isNull() | (F.col("h") <= 24), 100.0).when(F.col("h") <= 48, 80.0).when(F.col("h") <= 72, 60.0).otherwise(late)
    return row.select(clean.rounded(score).alias("timeliness"))


def dimensions(df: DataFrame, table: str, stage: str, as_of: str) -> DataFrame:
    """One row: the four dimensions, the weighted whole and the size."""
    parts = [completeness(df), uniqueness(df), validity(df), timeliness(df, as_of)]
    size = df.agg(F.count(F.lit(1)).alias("row_count"))
    out = size.withColumns({n: p.scalar() for n, p in zip(WEIGHTS, parts, strict=True)})
    whole = reduce(lambda a, b: a + b, [F.col(n) * w for n, w in WEIGHTS.items()])
    named = {"table_name": F.lit(table), "stage": F.lit(stage), "overall": F.round(whole, 2), "column_count": F.lit(len(df.columns))}
    return out.withColumns(named)


def compare_stages(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Row retention, column overlap and key integrity between two stages."""
    a, b = source.select(key).where(F.col(key).isNotNull()).distinct(), target.select(key).where(F.col(key).isNotNull()).distinct()
    both = a.withColumn("s", F.lit(1)).join(b.withColumn("t", F.lit(1)), key, "full")
    keys = both.agg(
        F.count("s").alias("source_keys"),
        F.count_if(F.col("t").isNull()).alias("missing_keys"),
        F.count_if(F.col("s").isNull()).alias("new_keys"),
    )
    shared = len(set(source.columns) & set(target.columns))
    rows = {
        "source_rows": source.agg(F.count(F.lit(1))).scalar(),
        "target_rows": target.agg(F.count(F.lit(1))).scalar(),
        "column_overlap_pct": F.lit(round(100.0 * shared / max(1, len(source.columns)), 2)),
    }
    out = keys.withColumns(rows)
    kept = F.coalesce(clean.percent(F.col("target_rows"), F.col("source_rows")), F.lit(100.0))
    sound = F.coalesce(clean.percent(F.col("source_keys") - F.col("missing_keys"), F.col("source_keys")), F.lit(100.0))
    return out.withColumns({"row_retention_pct": kept, "key_integrity_pct": sound})


def missing_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key the target lacks; null keys are missing."""
    return source.join(target.select(key), key, "left_anti")


def duplicate_rate(df: DataFrame) -> DataFrame:
    """Rows, repeated rows (all but the first of each) and their share."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    kinds = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    out = kinds.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
    return out.withColumn("duplicate_pct", F.coalesce(clean.percent(F.col("duplicate_rows"), F.col("row_count")), F.lit(0.0)))


def spot_check(source: DataFrame, target: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The n least keys of one side and whether the other side has them."""
    some = source.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(n)
    there = target.select(F.col(key).alias("_k")).distinct()
    return some.join(there, F.col(key) == F.col("_k"), "left").select(key, F.col("_k").isNotNull().alias("found"))


def save_profile(existing: DataFrame, profile: DataFrame, table: str, day: str) -> DataFrame:
    """A stored profile table with this table's profile of the day replaced."""
    new = profile.withColumns({"table_name": F.lit(table), "profile_date": F.lit(day).cast("date")})
    old = (F.col("table_name") == table) & (F.col("profile_date") == F.lit(day).cast("date"))
    return existing.where(~F.coalesce(old, F.lit(False))).unionByName(new, allowMissingColumns=True)


def latest_profile(stored: DataFrame, table: str) -> DataFrame:
    mine = stored.where(F.col("table_name") == table)
    return mine.where(F.col("profile_date") == mine.agg(F.max("profile_date")).scalar())


#: Size of the sketches: an HLL of 2**12 registers errs by 1.6 % (one standard
#: deviation), a KLL of this k by about 1.7 % of the rank.
HLL_LOG, KLL_K = 12, 200
SKETCH = "part string, column_name string, row_count long, null_count long, low double, high double, distinct_sketch binary, value_sketch binary"
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def sketch_columns(df: DataFrame, part: Column | None = None) -> DataFrame:
    """One row for each part of a table and column: counts, the least and
    greatest number, a sketch of its distinct values and one of its ranks.

    ``part`` names what is profiled apart and merged later (a day, a batch);
    without it the table is one part. Numbers that are NaN count as filled and
    stay out of the rank sketch; columns of other types have no ranks. Nested
    columns are left out. Rows are read once; tasks hold sketches, not values.
    """
    flat = [f for f in df.schema if not hasattr(f.dataType, "elementType") and f.dataType.typeName() not in ("struct", "map", "variant", "binary")]
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(flat):
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        aggs += [F.count(c).alias(f"f{i}"), F.hll_sketch_agg(c.cast("string"), F.lit(HLL_LOG)).alias(f"h{i}")]
        number = kind in NUMBERS or kind.startswith("decimal")
        if number:
            v = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
            aggs += [F.min(v).alias(f"l{i}"), F.max(v).alias(f"u{i}"), F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias(f"k{i}")]
        pick = lambda name, t, i=i, number=number: (F.col(f"{name}{i}") if number else F.lit(None)).cast(t)
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"), F.col("n").alias("row_count"), (F.col("n") - F.col(f"f{i}")).alias("null_count"),
                pick("l", "double").alias("low"), pick("u", "double").alias("high"), F.col(f"h{i}").alias("distinct_sketch"), pick("k", "binary").alias("value_sketch"),
            )
        )
    found = df.groupBy((F.lit("") if part is None else part.cast("string")).alias("part")).agg(*aggs)
    return found.select("part", F.explode(F.array(*rows)).alias("r")).select("part", "r.*")


def merge_sketches(parts: DataFrame) -> DataFrame:
    """The profile of all parts together, as if they had been one: sketches are
    merged, no row of the table is read again."""
    return parts.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("value_sketch").alias("value_sketch"),
    )


def sketched_profile(merged: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, row_count, null_count, null_pct, low, high, distinct_estimate,
    quantiles) out of merged sketches; no numbers: NULL quantiles."""
    quantile = lambda r: F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("value_sketch", F.lit(r)))
    return merged.select(
        "column_name", "row_count", "null_count",
        F.coalesce(F.round(F.col("null_count") * 100.0 / F.nullif(F.col("row_count"), F.lit(0)), 2), F.lit(0.0)).alias("null_pct"),
        "low", "high", F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), F.array(*[quantile(r) for r in ranks]).alias("quantiles"),
    )
