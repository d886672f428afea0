"""Rejection rules, quarantine, and scanning and masking of personal data."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions import clean, pii
from tarnlake.functions.pii import ENCRYPT_FROM, MASK_FROM, PATTERNS


@dataclass
class Rule:
    """kind: json_blob | pii | regex | custom (``pattern`` is SQL there);
    action: quarantine | mask | drop. No columns: every text column."""

    name: str
    kind: str
    columns: tuple[str, ...] = ()
    pattern: str | None = None
    severity: str = "warning"
    action: str = "quarantine"
    mask: str = "***"


# The default rules.
DEFAULT_RULES = (
    Rule("json_blob_in_text", "json_blob", ("location", "status_name", "method_of_contact", "lead_source")),
    Rule("credit_card_detected", "pii", (), PATTERNS["credit_card"].regex, "critical"),
    Rule("ssn_detected", "pii", (), PATTERNS["ssn"].regex, "critical"),
    Rule("email_in_unexpected_column", "pii", ("budget", "user_id", "lead_type_id"), PATTERNS["email"].regex, "warning", "mask", PATTERNS["email"].mask),
)


def _columns(df: DataFrame, rule: Rule) -> list[str]:
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    return [c for c in rule.columns if c in df.columns] if rule.columns else texts


def _hit(rule: Rule, c: Column) -> Column:
    return clean.is_json_blob(c) if rule.kind == "json_blob" else F.coalesce(c.cast("string").rlike(rule.pattern), F.lit(False))


def violations(df: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> Column:
    """Array of struct(rule, column, severity, action, sample), one per rule at
    most: the first column that matches. Samples of personal data are hidden."""
    found = []
    for r in rules:
        shape = lambda c, sample, r=r: F.struct(
            F.lit(r.name).alias("rule"), c.alias("column"), F.lit(r.severity).alias("severity"), F.lit(r.action).alias("action"), sample.alias("sample")
        )
        if r.kind == "custom":
            found.append(F.when(F.coalesce(F.expr(r.pattern), F.lit(False)), shape(F.lit(None).cast("string"), F.lit(None).cast("string"))))
            continue
        hits = []
        for name in _columns(df, r):
            c = F.col(f"`{name}`")
            sample = F.lit("[REDACTED]") if r.kind == "pii" else F.substring(c.cast("string"), 1, 100)
            hits.append(F.when(_hit(r, c), shape(F.lit(name), sample)))
        if hits:
            found.append(F.coalesce(*hits))
    if not found:
        return F.from_json(F.lit("[]"), "array<struct<rule:string,column:string,severity:string,action:string,sample:string>>")
    return F.filter(F.array(*found), lambda v: v.isNotNull())


def split(df: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected). Quarantine rules reject the row with its reasons;
    mask rules hide the matches and keep it; drop rules remove it silently.
    ``_original_index`` numbers the input rows (unique, rising by partition)."""
    judged = df.withColumns({"_v": violations(df, rules), "_original_index": F.monotonically_increasing_id()})
    has = lambda action: F.exists("_v", lambda v: v["action"] == action)
    masked = {}
    for r in rules:
        if r.action == "mask" and r.kind in ("pii", "regex"):
            for c in _columns(df, r):
                if dict(df.dtypes)[c] == "string":
                    masked[c] = F.regexp_replace(masked.get(c, F.col(f"`{c}`")), r.pattern, r.mask)
    kept = judged.where(~has("quarantine") & ~has("drop")).drop("_v", "_original_index").withColumns(masked)
    bad = judged.where(has("quarantine")).withColumns(
        {"_rejection_reason": F.col("_v"), "_rejection_time": F.current_timestamp() if at is None else at}
    )
    return kept, bad.drop("_v")


def summary(df: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """Per rule: records, severity and the columns hit."""
    v = df.select(F.explode(violations(df, rules)).alias("v")).select("v.*")
    return v.groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("records"), F.array_sort(F.collect_set("column")).alias("columns"))


def totals(df: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """Records, rejected records and the rejection rate in percent."""
    bad = F.count_if(F.exists(violations(df, rules), lambda v: v["action"] == "quarantine"))
    out = df.agg(F.count(F.lit(1)).alias("total"), bad.alias("rejected"))
    return out.withColumn("rejection_rate", F.coalesce(clean.percent(F.col("rejected"), F.col("total")), F.lit(0.0)))


def rejection_log(totals: DataFrame, summary: DataFrame, table: str, at: str) -> DataFrame:
    """A log row of a table's rejections, as they are appended to the log table:
    level, logger, source, message and the summary as JSON. No rejections: no row."""
    rules = summary.agg(F.array_sort(F.collect_list(F.struct("rule", "severity", "records", "columns"))).alias("rules"))  # one a rule
    both = totals.where("rejected > 0").crossJoin(F.broadcast(rules))
    message = F.format_string("Rejected %d/%d records (%s%%)", "rejected", "total", F.col("rejection_rate").cast("string"))
    facts = F.to_json(F.struct(F.lit(table).alias("table_name"), F.col("total").alias("total_records"), F.col("rejected").alias("rejected_records"), "rejection_rate", "rules"))
    return both.select(
        F.lit("WARNING").alias("log_level"), F.lit("rejection_handler").alias("logger_name"), F.lit(table).alias("source"),
        message.alias("message"), facts.alias("log_metadata"), F.lit(at).cast("timestamp").alias("logged_at"),
    )


def quarantine(rejected: DataFrame, path: str, table: str, batch: str, day: str) -> bool:
    """Append to table / date / batch folders; nothing to do on no rows."""
    if rejected.isEmpty():
        return False
    named = rejected.withColumns({"table_name": F.lit(table), "rejection_date": F.lit(day), "batch_id": F.lit(batch)})
    named.write.mode("append").partitionBy("table_name", "rejection_date", "batch_id").parquet(path)
    return True


def scan_pii(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """(table_name, column_name, pii_type, matches, sensitivity) where any.

    Every row is scanned, all columns and patterns in one aggregate pass.
    """
    cols = columns or [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    pairs = [(c, p) for c in cols for p in PATTERNS]
    row = df.agg(*[F.count_if(pii.holds(F.col(f"`{c}`"), p)).alias(f"{p}|{c}") for c, p in pairs])
    parts = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(p).alias("pii_type"), F.col(f"`{p}|{c}`").alias("matches"),
            F.lit(PATTERNS[p].sensitivity).alias("sensitivity"),
        )
        for c, p in pairs
    ]
    return row.select(F.explode(F.array(*parts)).alias("r")).select("r.*").where("matches > 0")


def classify(scan: DataFrame) -> DataFrame:
    """Class of each column with personal data, and what it needs."""
    types = F.collect_set("pii_type")
    has = lambda *names: reduce(lambda a, b: a | b, [F.array_contains("pii_types", n) for n in names])
    out = scan.groupBy("table_name", "column_name").agg(F.array_sort(types).alias("pii_types"), F.max("sensitivity").alias("sensitivity"))
    kind = F.when(has("credit_card", "ssn"), "financial").when(has("email", "phone"), "pii").otherwise("sensitive")
    return out.withColumns(
        {"classification": kind, "needs_masking": F.col("sensitivity") >= MASK_FROM, "needs_encryption": F.col("sensitivity") >= ENCRYPT_FROM}
    )


def mask_columns(df: DataFrame, types: dict[str, list[str]]) -> DataFrame:
    """Replace each listed type in each column, in pattern order; NULL stays."""
    return df.withColumns({c: pii.masked(F.col(f"`{c}`"), names) for c, names in types.items()})


def mask_pii(df: DataFrame, classification: DataFrame | None = None) -> DataFrame:
    """Mask the columns that a classification (or a scan of ``df``) names."""
    found = classify(scan_pii(df, "t")) if classification is None else classification
    rows = found.where("needs_masking").select("column_name", "pii_types").collect()  # one row per column
    return mask_columns(df, {r.column_name: r.pii_types for r in rows if r.column_name in df.columns})
