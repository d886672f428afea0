import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.functions.pii import PATTERNS
from tarnlake.operators import alerts, contracts, profiling, rejects
from tarnlake.operators import expectations as x
from tarnlake.operators.staging import Mapped, TableConfig
from tarnlake.plans import registry
from tarnlake.streaming import cdc

AT = "2024-01-10 00:00:00"
PII = [
    (1, "mail bob@example.com now", "a"),
    (2, "call 212-555-0188 or +971 50 123 4567", "b"),
    (3, "card 4111111111111111 and 10.1.2.3", "c"),
    (4, "ssn 123-45-6789", None),
    (5, "not 000-45-6789 nor 666-45-6789 nor 923-45-6789 nor 123-00-6789", "e"),
    (6, "id 784-1990-1234567-1", "f"),
    (7, None, "g"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PII, "id int, note string, other string")


def test_profile_edges(spark):
    df = spark.createDataFrame([(1.0, None, 5, "x"), (None, None, 5, "")], "a double, b double, c int, s string")
    n = {r.column_name: r for r in profiling.numeric_profile(df, ["a", "b", "c"]).collect()}
    assert n["a"].std == 0.0 and n["b"].mean is None and n["c"].std == 0.0 and n["c"].median == 5.0
    o = {r.column_name: r.outliers for r in profiling.iqr_outliers(df, ["a", "b", "c"]).collect()}
    assert o == {"a": 0, "b": 0, "c": 0}
    wide = spark.createDataFrame([(float(v),) for v in [*range(20), 500]], "v double")
    assert profiling.iqr_outliers(wide, ["v"]).first().outliers == 1
    c = {r.column_name: r for r in profiling.completeness_profile(df).collect()}
    assert (c["b"].null_count, c["b"].distinct_count, c["c"].duplicate_count, c["s"].distinct_count) == (2, 0, 1, 2)
    approx = {r.column_name: r.distinct_count for r in profiling.completeness_profile(df, approximate=True).collect()}
    assert approx["c"] == 1
    whole = profiling.profile_table(df, "t")
    assert set(whole) == {"columns", "numeric", "outliers", "string", "top"}
    s = profiling.profile_summary(whole["columns"], whole["outliers"]).first()
    assert (s.columns_with_nulls, s.null_cell_pct, s.completeness) == (2, 37.5, 62.5)
    moved = profiling.profile_drift(whole["numeric"], profiling.numeric_profile(df.na.fill(3.0), ["a", "b", "c"]), ["mean"])
    assert {r.column_name: r.change for r in moved.collect()}["a"] == 1.0
    empty = profiling.profile_table(df.limit(0), "t")
    assert empty["columns"].count() == 4 and empty["numeric"].first().zeros == 0


def test_dimensions(spark):
    df = spark.createDataFrame([("1", "2024-01-09 23:00:00"), ("1", None)], "k string, updated_at string")
    d = profiling.dimensions(df, "t", "raw", AT).first()
    assert (d.completeness, d.uniqueness, d.validity, d.timeliness, d.row_count) == (75.0, 75.0, 100.0, 100.0, 2)
    assert d.overall == 0.3 * 75 + 0.25 * 75 + 0.25 * 100 + 0.2 * 100
    hours = {"2024-01-08 12:00:00": 80.0, "2024-01-07 12:00:00": 60.0, "2024-01-06 12:00:00": 0.0, "2024-01-06 23:00:00": 4.0}
    for at, score in hours.items():
        one = spark.createDataFrame([(at,)], "created_at string")
        assert profiling.timeliness(one, AT).first()[0] == score or at == "2024-01-06 23:00:00"
    none = profiling.dimensions(df.limit(0), "t", "raw", AT).first()
    assert (none.completeness, none.uniqueness, none.validity, none.timeliness) == (100.0, 100.0, 100.0, 100.0)
    c = profiling.compare_stages(df, df.limit(0), "k").first()
    assert (c.row_retention_pct, c.missing_keys, c.key_integrity_pct) == (0.0, 1, 0.0)


def test_contract_and_registry(spark):
    config = TableConfig("t", [Mapped("a", "a"), Mapped("b", "b")])
    df = spark.createDataFrame([("x", 1.5)], "a string, c double")
    expected, actual = contracts.expected_schema(spark, config), contracts.schema_rows(df, "t")
    d = {r.column_name: (r.change, r.severity) for r in contracts.drift(expected, actual).collect()}
    assert d == {"b": ("missing", "error"), "c": ("new", "warning")}
    assert contracts.integrity(expected, actual).first().integrity == 35.0
    reg = contracts.register(contracts.empty_registry(spark), actual, "staging", "me", AT)
    same = contracts.register(reg, actual, "staging", "me", AT)
    assert same.agg(F.max("version")).first()[0] == 1 and same.count() == 2
    wider = contracts.schema_rows(df.withColumn("c", F.col("c").cast("string")).withColumn("n", F.lit(1)).drop("a"), "t")
    log = {r.column_name: r.change for r in contracts.evolution(reg, wider).collect()}
    assert log == {"a": "column_removed", "c": "type_changed", "n": "column_added"}
    two = contracts.register(reg, wider, "staging", "me", AT)
    assert [r.column_name for r in contracts.get_schema(two, "t").collect()] == ["c", "n"]
    assert contracts.get_schema(two, "t", 1).count() == 2 and contracts.schema_history(two, "t").first().version == 2
    assert contracts.catalog_summary(two).first().names == ["t"]
    assert contracts.canonical(spark.range(1).select(F.array(F.lit("1.5").cast("decimal(2,1)")).alias("x")).schema["x"].dataType) == "array<decimal(2,1)>"
    assert contracts.database_type("Character Varying(50)") == "string" and contracts.database_type("jsonb") == "json"
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "c"), ("c", "a")], "source string, target string")
    assert {r.asset: r.distance for r in contracts.upstream(edges, "c").collect()} == {"b": 1, "x": 1, "a": 2}


def test_crawler(spark, tmp_path):
    df = spark.range(3).withColumn("year", F.lit(2024))
    df.write.partitionBy("year").parquet(f"{tmp_path}/dim_a")
    df.write.parquet(f"{tmp_path}/fact_b")
    reg, counts = contracts.run_crawler(spark, contracts.empty_registry(spark), str(tmp_path), "me", AT)
    assert counts == {"new": 2, "updated": 0, "unchanged": 0, "failed": 0}
    _, counts = contracts.run_crawler(spark, reg, str(tmp_path), "me", AT)
    assert counts == {"new": 0, "updated": 0, "unchanged": 2, "failed": 0}
    lake = {r.table_name: r for r in contracts.crawl_lake(spark, str(tmp_path)).collect()}
    assert lake["dim_a"].partition_keys == ["year"] and lake["fact_b"].partition_keys == []


def test_rejects(people):
    rules = (*rejects.DEFAULT_RULES, rejects.Rule("hide", "pii", ("note",), PATTERNS["email"].regex, action="mask", mask="***"))
    good, bad = rejects.split(people, rules)
    assert {r.id for r in bad.collect()} == {3, 4} and good.count() + bad.count() == people.count()
    assert {r.id: r.note for r in good.collect()}[1] == "mail *** now"
    reason = {r.id: r._rejection_reason for r in bad.collect()}
    assert reason[3][0]["rule"] == "credit_card_detected" and reason[3][0]["sample"] == "[REDACTED]"
    assert rejects.totals(people, rules).first().rejection_rate == round(200 / 7, 2)
    assert {r.rule for r in rejects.summary(people, rules).collect()} == {"credit_card_detected", "ssn_detected", "hide"}
    assert rejects.totals(people.limit(0)).first().rejection_rate == 0.0 and rejects.split(people, ())[1].count() == 0


def test_quarantine(spark, people, tmp_path):
    _, bad = rejects.split(people)
    assert rejects.quarantine(bad, str(tmp_path / "q"), "people", "b1", "2024-01-01")
    assert not rejects.quarantine(bad.limit(0), str(tmp_path / "q"), "people", "b2", "2024-01-01")
    assert spark.read.parquet(str(tmp_path / "q")).where("batch_id = 'b1'").count() == 2


def test_pii(people):
    found = {(r.column_name, r.pii_type): r.matches for r in rejects.scan_pii(people, "people").collect()}
    assert found["note", "ssn"] == 1 and found["note", "email"] == 1 and found["note", "emirates_id"] == 1 and found["note", "ip_address"] == 1
    c = rejects.classify(rejects.scan_pii(people, "people")).first()
    assert (c.classification, c.needs_masking, c.needs_encryption) == ("financial", True, True)
    masked = {r.id: r.note for r in rejects.mask_pii(people).collect()}
    assert masked[7] is None and masked[4] == "ssn ***-**-****" and "@example" not in masked[1] and "10.1.2.3" not in masked[3]


def test_suite(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "ccc")], "id int, v string")
    suite = [
        x.Expectation.parse({"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "id"}, "meta": {"severity": "critical"}}),
        x.Expectation("expect_column_values_to_be_unique", {"column": "id", "mostly": 0.5}),
        x.Expectation("expect_column_values_to_not_be_null", {"column": "v", "mostly": 0.75}),
        x.Expectation("expect_column_values_to_not_be_null", {"column": "v", "mostly": 0.76}),
        x.Expectation("expect_column_values_to_not_match_regex", {"column": "v", "regex": "c+"}),
        x.Expectation("expect_column_value_lengths_to_be_between", {"column": "v", "max_value": 3}),
        x.Expectation("expect_table_columns_to_match_set", {"column_set": ["id", "v", "w"], "exact_match": False}),
        x.Expectation("expect_table_row_count_to_be_between", {"min_value": 1, "max_value": 4}),
        x.Expectation("expect_column_values_to_be_in_set", {"column": "gone", "value_set": [1]}),
        x.Expectation("expect_something_else", {"column": "v"}),
    ]
    r = x.run_suite(df, suite)
    assert [e.success for e in r.collect()] == [False, True, True, False, False, True, False, True, False, False]
    assert x.statistics(r).first().blocking_failures == 1
    with pytest.raises(x.GateFailed, match="unique"):
        x.checkpoint(df, suite)
    assert x.checkpoint(df, suite, raise_on_failure=False).count() == 10
    assert x.run_suite(df.limit(0), suite[:3]).where("success").count() == 3


def test_rules(spark):
    df = spark.createDataFrame([(1, "5", "2024-01-09 00:00:00"), (1, "x", "2024-01-01 00:00:00"), (None, None, None)], "id int, v string, at string")
    R = x.QualityRule
    failed = lambda r, **k: x.execute_rule(df, r, **k).first().failed
    assert failed(R("n", "null_check", "id")) == 1 and failed(R("r", "range_check", "id", {"min": 2})) == 2
    assert failed(R("g", "regex_check", "v", {"pattern": "^\\d"})) == 1 and failed(R("t", "type_check", "v", {"type": "int"})) == 1
    assert failed(R("u", "uniqueness_check", "id")) == 2 and failed(R("f", "freshness_check", "at", {"max_hours": 48}), as_of=AT) == 1
    parent = spark.createDataFrame([(2,)], "k int")
    assert failed(R("p", "referential", "id", {"table": "p", "key": "k"}), parents={"p": parent}) == 2
    out = x.execute_rule(df, R("c", "custom_sql", None, {"condition": "id = 1 and v = '5'"})).first()
    assert (out.checked, out.passed, out.failed, len(out.samples)) == (3, 1, 2, 2) and out.pass_rate == 33.33


def minutes(spark, *ms):
    at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
    df = spark.createDataFrame([("k", "warning", "s", "t", "m", at(m)) for m in ms], alerts.ALERT.replace("timestamp", "string"))
    return df.withColumn("created_at", F.col("created_at").cast("timestamp"))


def test_suppression_runs_from_the_last_kept(spark):
    kept = alerts.suppress(minutes(spark, 0, 30, 59, 61, 90, 125))
    assert sorted(r.created_at.hour * 60 + r.created_at.minute for r in kept.collect()) == [0, 61, 125]
    last = kept.groupBy("dedup_key").agg(F.max("created_at").alias("emitted_at"))
    later = alerts.suppress(minutes(spark, 150, 190), last_emitted=last)
    assert [r.created_at.minute for r in later.collect()] == [10]
    assert alerts.suppress(minutes(spark)).count() == 0


def test_alert_life_cycle(spark):
    df = alerts.opened(alerts.suppress(minutes(spark, 0).unionByName(alerts.built_alert(spark, "pipeline", "fatal", "p", "t", "m", AT))))
    assert {r.severity for r in df.collect()} == {"warning"}
    keys = [r.dedup_key for r in df.collect()]
    df = alerts.resolve(alerts.acknowledge(df, keys[:1], "me", AT), keys[1:], "done", AT)
    assert alerts.open_alerts(df).count() == 1 and alerts.open_alerts(df).first().status == "acknowledged"


def test_alert_sources(spark, people):
    d = spark.createDataFrame([("t", 30.0, 95.0, 95.0, 69.0, 50.0)], "table_name string, completeness double, uniqueness double, validity double, timeliness double, overall double")
    got = {r.title: r.severity for r in alerts.score_alerts(d, AT).collect()}
    assert got == {"completeness below limit": "critical", "timeliness below limit": "warning", "overall below limit": "warning"}
    r = alerts.rejection_alerts(rejects.totals(people), rejects.summary(people), "people", AT)
    assert {a.alert_type for a in r.collect()} == {"rejection_rate", "critical_rule"}
    assert alerts.pii_alerts(rejects.scan_pii(people, "people"), AT).where("severity = 'critical'").count() >= 2
    drift = spark.createDataFrame([("c", "new", "warning")], "column_name string, change string, severity string")
    low = spark.createDataFrame([(60.0,)], "integrity double")
    assert sorted(a.severity for a in alerts.drift_alerts(drift, low, "t", AT).collect()) == ["error", "warning"]
    old = spark.createDataFrame([("t", "2024-01-01 00:00:00"), ("u", "2024-01-09 12:00:00")], "table_name string, last_update string")
    assert [a.source for a in alerts.freshness_alerts(old, AT).collect()] == ["t"]


def test_metrics(spark):
    rows = [alerts.metric(spark, "rows", "counter", v, {"t": "a"}, AT) for v in (1, 2)] + [alerts.metric(spark, "lag", "gauge", v, {"t": "a"}, at) for v, at in ((5, AT), (3, "2024-01-11"))]
    df = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    assert {r.name: r.value for r in alerts.roll_up(df, ["t"]).collect()} == {"rows": 3.0, "lag": 3.0}
    one = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert {r.name: r.value for r in alerts.metric_rows(one, ["a", "b"], {"x": 1}, AT).collect()} == {"a": 1.0, "b": 2.5}
    assert alerts.log_row(spark, "INFO", "done", {"n": 1}, AT).first().fields == {"n": "1"}
    r = spark.createDataFrame([("t", "raw", True, True), ("t", "raw", False, True)], "table_name string, stage string, success boolean, blocking boolean")
    assert alerts.quality_report(r).first().blocking_failures == 1


def test_thresholds(spark):
    m = spark.createDataFrame([("t", None, "n", 5.0), ("t", "c", "p", 50.0), ("u", "c", "p", 5.0)], "table_name string, column_name string, metric string, value double")
    t = spark.createDataFrame(
        [(None, None, "n", "equals", 5.0, None, "error", True), ("t", "c", "p", "max", None, 20.0, "warning", False)],
        "table_name string, column_name string, metric string, kind string, low double, high double, severity string, blocking boolean",
    )
    assert sorted((r.metric, r.holds) for r in x.check_thresholds(m, t).collect()) == [("n", True), ("p", False)]


def test_suppression_of_a_key_of_very_many_times(spark):
    """Chains through blocks equal the fold over sorted times, dense and sparse,
    whether a key is one block, several, or a block for each slot."""
    at = F.timestamp_micros((F.lit(1_700_000_000_000_000) + F.col("id") * 7_000_000).cast("long"))
    hot = spark.range(60_000).select(F.lit("k").alias("alert_type"), F.lit("warning").alias("severity"), F.lit("hot").alias("source"), F.lit("t").alias("title"), F.lit("m").alias("message"), at.alias("created_at"))
    rnd = random.Random(1)
    few = [("k", "error", "few", "t", "m", datetime(2020, 1, 1) + timedelta(minutes=rnd.choice([1, 20, 59, 60, 61]) * i + rnd.randrange(3000) * (i % 7 == 0))) for i in range(80)]
    rows = hot.unionByName(spark.createDataFrame(few, hot.schema))
    rows = rows.unionByName(spark.createDataFrame([("k", "info", "odd", "t", "m", datetime(1969, 12, 30) + timedelta(minutes=m)) for m in (0, 59, 61, 119, 121, 125, 7000, 7059)], hot.schema))
    run = lambda **how: sorted((r.source, r.created_at) for r in alerts.suppress(rows, **how).select("source", "created_at").collect())
    got = run()
    want = []
    for source in ("few", "hot", "odd"):
        last = None
        for (t,) in rows.where(F.col("source") == source).select("created_at").distinct().orderBy("created_at").collect():
            if last is None or t >= last + timedelta(minutes=60):
                last = t
                want.append((source, t))
    assert got == want and 100 < len(want)
    assert run(block_rows=1) == want and run(block_rows=2000) == want


def test_stale_tables_are_aged_by_the_clock(spark):
    """Ages count the seconds of the clock; halves below a half go down, as in SQL."""
    at = "2024-01-10 00:00:00"
    seconds = [24 * 3600 + 18 * k for k in range(1, 2000)]
    last = spark.createDataFrame([(str(s), s) for s in seconds], "table_name string, s long")
    last = last.select("table_name", F.timestamp_add("SECOND", -F.col("s"), F.lit(at).cast("timestamp_ntz")).alias("last_update"))
    got = {r.source: float(r.message) for r in alerts.freshness_alerts(last, at).collect()}
    assert got == dict(duckdb.execute("SELECT s::VARCHAR, round(s / 3600.0, 2) FROM (SELECT unnest(?::BIGINT[]) AS s)", [seconds]).fetchall())
    part = spark.createDataFrame([("t", "2024-01-08 23:59:59.5"), ("u", "2024-01-09 00:00:00.5"), ("v", None)], "table_name string, last_update string")
    assert [(a.source, a.message) for a in alerts.freshness_alerts(part, at).collect()] == [("t", "24.0")]


def test_timeliness_agrees_with_sql(spark, tmp_path):
    """Newest times with a fraction of a second, at the steps and on halves."""
    as_of = datetime.fromisoformat(registry.AS_OF)
    ages = [timedelta(hours=h, microseconds=us) for h in (24, 48, 72) for us in (-1, 0, 1, 500_000, 999_999)]
    ages += [timedelta(hours=26, seconds=9 * k, milliseconds=250) for k in (1, 401, 5555, 17001)] + [timedelta(hours=-1), timedelta(days=90)]
    ages += [timedelta(hours=73, seconds=9 * k) for k in range(1, 40, 2)]
    times = spark.createDataFrame([(as_of - age,) for age in ages], "at timestamp_ntz")
    got = [profiling.timeliness(times.where(F.col("at") == as_of - age).withColumnRenamed("at", "updated_at"), registry.AS_OF).withColumn("i", F.lit(i)) for i, age in enumerate(ages)]
    whole = got[0]
    for g in got[1:]:
        whole = whole.unionByName(g)
    for i, r in enumerate(whole.orderBy("i").collect()):
        sql = registry.ORACLE_SQL["dq_timeliness"].replace("FROM events", f"FROM (SELECT TIMESTAMP '{as_of - ages[i]}' AS ts)")
        assert r.timeliness == duckdb.execute(sql).fetchone()[0], ages[i]


def test_seconds_count_as_in_sql(spark):
    """Freshness rules, lag and ranges of days by the clock, also before 1970."""
    at, hours = "2024-01-10 00:00:00", 240
    texts = ["2023-12-30 23:59:59.999999", "2023-12-31 00:00:00", "2023-12-31 00:00:00.5", "2023-12-30 23:59:59", "1969-12-31 23:59:58.5", "2024-01-10 00:00:00.5", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.col("t").cast("timestamp_ntz").alias("t"))
    values = duckdb.execute("SELECT date_diff('second', t, ?::TIMESTAMP) FROM (SELECT unnest(?::TIMESTAMP[]) AS t)", [at, texts]).fetchall()
    got = [tuple(r) for r in df.orderBy("i").select(clean.seconds_between(F.col("t"), F.lit(at))).collect()]
    assert got == values
    rule = x.QualityRule("f", "freshness_check", "t", {"max_hours": hours})
    assert x.execute_rule(df, rule, as_of=at).first().failed == sum(v is not None and v > hours * 3600 for (v,) in values) == 3
    assert cdc.lag_seconds(df.where("i = 0"), "t", at).first()[0] == values[0][0]
    days = spark.createDataFrame([("2024-01-01 00:00:00.9",), ("2024-01-02 00:00:00.1",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert profiling.datetime_profile(days, ["t"]).first().range_days == 1
