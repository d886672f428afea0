"""Expectation suites, rule tables and thresholds.

All column metrics of a suite come from one aggregate; only uniqueness needs a
group by its column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnlake.functions import clean

RESULT = "expectation string, column_name string, success boolean, blocking boolean, checked long, failed long, fraction double, detail string"


@dataclass
class Expectation:
    kind: str
    kwargs: dict = field(default_factory=dict)
    blocking: bool = False

    @classmethod
    def parse(cls, item: dict) -> Expectation:
        """From {expectation_type, kwargs, meta: {severity|blocking}}."""
        meta = item.get("meta", {})
        return cls(item["expectation_type"], item.get("kwargs", {}), bool(meta.get("blocking")) or meta.get("severity") == "critical")


def _fits(kind: str, c: Column, k: dict) -> Column | None:
    """Condition on a non-null value, for expectations on values."""
    text = c.cast("string")
    if kind == "expect_column_values_to_be_in_set":
        return c.isin(*k["value_set"])
    if kind == "expect_column_values_to_match_regex":
        return text.rlike(f"^(?:{k['regex']})")
    if kind == "expect_column_values_to_not_match_regex":
        return ~text.rlike(f"^(?:{k['regex']})")
    if kind in ("expect_column_value_lengths_to_be_between", "expect_column_values_to_be_between"):
        v = F.length(text) if "lengths" in kind else c
        low, high = k.get("min_value"), k.get("max_value")
        return (F.lit(True) if low is None else v >= low) & (F.lit(True) if high is None else v <= high)
    return None


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation. A missing column or an unknown kind fails its
    expectation with a detail and does not stop the others. ``mostly`` is the
    share of non-null values (for not-null: of all rows) that must pass."""
    spark = df.sparkSession
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, e in enumerate(suite):
        name = e.kwargs.get("column")
        if name not in df.columns:
            continue
        c = F.col(f"`{name}`")
        aggs.append(F.count(c).alias(f"filled_{i}"))
        fits = _fits(e.kind, c, e.kwargs)
        if fits is not None:
            aggs.append(F.count_if(c.isNotNull() & ~F.coalesce(fits, F.lit(False))).alias(f"bad_{i}"))
    row = df.agg(*aggs).first()
    out = []
    for i, e in enumerate(suite):
        out.append(_judge(df, e, i, row))
    return spark.createDataFrame(out, RESULT)


def _judge(df: DataFrame, e: Expectation, i: int, row) -> tuple:
    k, name = e.kwargs, e.kwargs.get("column")
    rows = row["rows"]

    def answer(ok: bool, checked: int, failed: int, detail: str = "") -> tuple:
        fraction = 1.0 if not checked else (checked - failed) / checked
        return e.kind, name, ok, e.blocking, checked, failed, fraction, detail

    if e.kind == "expect_table_row_count_to_be_between":
        low, high = k.get("min_value"), k.get("max_value")
        return answer((low is None or rows >= low) and (high is None or rows <= high), rows, 0, f"{rows} rows")
    if e.kind == "expect_table_columns_to_match_set":
        want, have = set(k["column_set"]), set(df.columns)
        lost, more = sorted(want - have), sorted(have - want)
        return answer(not lost and not (k.get("exact_match", True) and more), len(want), len(lost), f"missing {lost}, more {more}")
    if e.kind == "expect_column_to_exist":
        return answer(name in df.columns, 1, int(name not in df.columns))
    if name not in df.columns:
        return answer(False, 0, 0, f"no column {name}")
    mostly, filled = k.get("mostly", 1.0), row[f"filled_{i}"]
    if e.kind == "expect_column_values_to_not_be_null":
        checked, failed = rows, rows - filled
    elif e.kind == "expect_column_values_to_be_unique":
        c = F.col(f"`{name}`")
        repeated = df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        checked, failed = filled, repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    elif f"bad_{i}" in row.asDict():
        checked, failed = filled, row[f"bad_{i}"]
    else:
        return answer(False, 0, 0, f"unknown expectation {e.kind}")
    return answer(not checked or (checked - failed) / checked >= mostly, checked, failed)


def statistics(results: DataFrame) -> DataFrame:
    ok = F.count_if("success")
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        ok.alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
        F.round(ok * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 2).alias("success_pct"),
        F.count_if(F.col("blocking") & ~F.col("success")).alias("blocking_failures"),
    )


class GateFailed(Exception):
    """A blocking expectation failed."""


def checkpoint(df: DataFrame, suite: list[Expectation], raise_on_failure: bool = True) -> DataFrame:
    results = run_suite(df, suite)
    bad = results.where("blocking and not success").collect()  # one row per expectation at most
    if bad and raise_on_failure:
        raise GateFailed(", ".join(f"{r.expectation}({r.column_name})" for r in bad))
    return results


@dataclass
class QualityRule:
    """kind: null_check | range_check | regex_check | type_check |
    uniqueness_check | freshness_check | referential | custom_sql."""

    name: str
    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict)


#: Kinds judged by a condition on the row alone.
BY_ROW = ("null_check", "range_check", "regex_check", "type_check", "freshness_check", "custom_sql")


def broken(rule: QualityRule, as_of: str | None = None) -> Column:
    """Condition of a row that breaks a rule of a kind in ``BY_ROW``; never NULL."""
    c, p = F.col(f"`{rule.column}`") if rule.column else None, rule.params
    if rule.kind == "null_check":
        bad = c.isNull()
    elif rule.kind == "range_check":
        low, high = p.get("min"), p.get("max")
        bad = F.lit(False) if low is None else c < low
        bad = bad | (F.lit(False) if high is None else c > high)
        if p.get("allow_null") is False:
            bad = c.isNull() | bad
    elif rule.kind == "regex_check":
        bad = ~c.cast("string").rlike(p["pattern"])
    elif rule.kind == "type_check":
        bad = c.isNotNull() & c.cast("string").try_cast(p["type"]).isNull()
        if p.get("disallow_json"):
            bad = bad | clean.is_json_blob(c.cast("string"))
    elif rule.kind == "freshness_check":
        bad = clean.seconds_between(c, F.lit(as_of)) > p["max_hours"] * 3600
    elif rule.kind == "custom_sql":
        bad = ~F.coalesce(F.expr(f"({p['condition']})"), F.lit(False))
    else:
        raise ValueError(f"unknown rule kind {rule.kind}")
    return F.coalesce(bad, F.lit(False))


def failing(df: DataFrame, rule: QualityRule, parents: dict[str, DataFrame] | None = None, as_of: str | None = None) -> DataFrame:
    """Rows that break the rule."""
    c = F.col(f"`{rule.column}`") if rule.column else None
    if rule.kind == "uniqueness_check":
        more = df.where(c.isNotNull()).groupBy(c.alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k")
        return df.join(more, c == F.col("_k"), "left_semi")
    if rule.kind == "referential":
        parent = (parents or {})[rule.params["table"]].select(F.col(rule.params["key"]).alias("_k"))
        return df.where(c.isNotNull()).join(parent, c == F.col("_k"), "left_anti")
    return df.where(broken(rule, as_of))


RULE_RESULT = "rule string, checked long, passed long, failed long, pass_rate double, samples array<string>"


def run_rules(df: DataFrame, rules: list[QualityRule], parents: dict[str, DataFrame] | None = None, as_of: str | None = None, samples: int = 5) -> DataFrame:
    """(rule, checked, passed, failed, pass_rate, samples) of all rules of a table.

    The rules are compiled together: one aggregate counts for all that a row
    alone decides, each unique key is one group-by, each reference one count by
    value and one anti-join with its parent. ``samples`` failing rows a rule, as
    JSON, the least in text order, come from one more pass in which every task
    keeps no more than that many a rule; 0 leaves the pass out. A rule over a
    column that the table lacks fails for all rows, with no samples; no rows:
    nothing fails. Rules are not judged on the driver; the plan is lazy.
    """
    spark = df.sparkSession
    if not rules:
        return spark.createDataFrame([], RULE_RESULT)
    lacking = {i for i, r in enumerate(rules) if r.column and r.column not in df.columns}
    by_row = {i: broken(r, as_of) for i, r in enumerate(rules) if i not in lacking and r.kind in BY_ROW}
    unknown = [r.kind for i, r in enumerate(rules) if i not in lacking and r.kind not in (*BY_ROW, "uniqueness_check", "referential")]
    if unknown:
        raise ValueError(f"unknown rule kinds {sorted(set(unknown))}")
    n = F.count(F.lit(1))
    row = df.agg(n.alias("n"), *[F.count_if(bad).alias(f"r{i}") for i, bad in by_row.items()])
    pairs = [F.struct(F.lit(i).alias("i"), F.col(f"r{i}").alias("failed")) for i in by_row]
    pairs += [F.struct(F.lit(i).alias("i"), F.col("n").alias("failed")) for i in lacking]
    counts = row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*") if pairs else spark.createDataFrame([], "i int, failed long")
    for i, r in enumerate(rules):
        if i in by_row or i in lacking:
            continue
        values = df.where(F.col(f"`{r.column}`").isNotNull()).groupBy(F.col(f"`{r.column}`").alias("_v")).agg(n.alias("_n"))
        if r.kind == "uniqueness_check":
            bad = values.where("_n > 1")
        else:
            parent = (parents or {})[r.params["table"]].select(F.col(r.params["key"]).alias("_k"))
            bad = values.join(parent, F.col("_v") == F.col("_k"), "left_anti")
        counts = counts.unionByName(bad.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failed")).select(F.lit(i).alias("i"), "failed"))
    names = spark.createDataFrame([(i, r.name) for i, r in enumerate(rules)], "i int, rule string")
    out = names.join(counts, "i").crossJoin(F.broadcast(row.select(F.col("n").alias("checked"))))  # one row
    if samples:
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row")
        hits = F.filter(F.array(*[F.when(bad, F.lit(i)) for i, bad in by_row.items()]), lambda x: x.isNotNull()) if by_row else F.array().cast("array<int>")
        shown = df.select(F.explode(hits).alias("i"), text)
        for i, r in enumerate(rules):
            if i not in by_row and i not in lacking:
                shown = shown.unionByName(failing(df, r, parents, as_of).select(F.lit(i).alias("i"), text))
        nth = F.row_number().over(W.partitionBy("i").orderBy("row"))
        few = shown.withColumn("nth", nth).where(F.col("nth") <= samples).groupBy("i").agg(F.array_sort(F.collect_list("row")).alias("samples"))
        out = out.join(few, "i", "left").withColumn("samples", F.coalesce("samples", F.array().cast("array<string>")))
    else:
        out = out.withColumn("samples", F.array().cast("array<string>"))
    rate = F.coalesce(clean.rounded((F.col("checked") - F.col("failed")) * 100.0 / F.nullif(F.col("checked"), F.lit(0))), F.lit(100.0))
    return out.select("rule", "checked", (F.col("checked") - F.col("failed")).alias("passed"), "failed", rate.alias("pass_rate"), "samples")


def execute_rule(df: DataFrame, rule: QualityRule, parents: dict[str, DataFrame] | None = None, as_of: str | None = None, samples: int = 5) -> DataFrame:
    """(rule, checked, passed, failed, pass_rate, samples) of one rule."""
    return run_rules(df, [rule], parents, as_of, samples)


def check_thresholds(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Join metrics (table_name, column_name, metric, value) with thresholds
    (table_name or NULL for any, column_name or NULL, metric, kind, low, high,
    severity, blocking) and say which hold."""
    m, t = metrics.alias("m"), thresholds.alias("t")
    fits = (
        (F.col("m.metric") == F.col("t.metric"))
        & (F.col("t.table_name").isNull() | (F.col("t.table_name") == F.col("m.table_name")))
        & (F.col("t.column_name").isNull() | (F.col("t.column_name") == F.col("m.column_name")))
    )
    v, low, high = F.col("m.value"), F.col("t.low"), F.col("t.high")
    ok = (
        F.when(F.col("t.kind") == "min", v >= low)
        .when(F.col("t.kind") == "max", v <= high)
        .when(F.col("t.kind") == "equals", v == low)
        .when(F.col("t.kind").isin("between", "percentage"), v.between(low, high))
    )
    return m.join(t, fits).select("m.table_name", "m.column_name", "m.metric", "m.value", "t.kind", "t.severity", "t.blocking", ok.alias("holds"))
