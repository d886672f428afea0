from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.functions import clean
from tarnlake.operators import alerts, contracts, ingest, profiling, rejects
from tarnlake.session import materialize, release

AT = "2024-02-01 00:00:00"


def test_mapping_document():
    place = {"schema-name": "shop", "table-name": "leads"}
    rules = [
        {"rule-type": "selection", "rule-action": "explicit", "object-locator": place, "cdc-config": {"tracking-column": "updated_at", "delete-column": "merged", "delete-value": "TRUE"}},
        {"rule-type": "selection", "rule-action": "exclude", "object-locator": {"schema-name": "shop", "table-name": "tmp"}},
        {"rule-type": "transformation", "rule-action": "add-prefix", "rule-target": "table", "value": "in_"},
        {"rule-type": "transformation", "rule-action": "rename", "rule-target": "schema", "object-locator": {"schema-name": "shop"}, "value": "lake"},
    ]
    found = ingest.read_mappings({"rules": rules})
    (t,) = found.tables
    assert (t.schema, t.name, t.id_column, t.tracking, t.delete_when, t.prefix) == ("shop", "leads", "id", "updated_at", ("merged", "TRUE"), "in_")
    assert ingest.target_path(t, "cdc", "b1", found.schemas) == "lake/in_leads/cdc/b1"
    bare = ingest.read_mappings({"rules": rules[:1]}, {"task_settings": {"table_prefix": "raw_"}})
    assert bare.prefix == "raw_" and bare.schemas == {} and ingest.read_mappings({}).tables == []


def test_metric_builders(spark):
    run = {r.name: (r.kind, r.value, r.labels) for r in alerts.run_metrics(spark, "load", 1.5, "ok", AT, 10, 2).collect()}
    assert run["pipeline_rows_rejected"] == ("counter", 2.0, {"pipeline_name": "load", "table_name": "all", "reason": "quality_check"})
    assert len(run) == 3 and alerts.run_metrics(spark, "load", 1.5, "ok", AT).count() == 1
    results = spark.createDataFrame([("t", "c", True, "error"), ("t", "d", False, "error")], "table_name string, check_name string, success boolean, severity string")
    made = {r.name: r.labels for r in alerts.check_metrics(results, AT).collect()}
    assert made == {"dq_check_passed": {"table_name": "t", "check_name": "c"}, "dq_check_failed": {"table_name": "t", "check_name": "d", "severity": "error"}}


def test_profiles_stored_and_listed(spark):
    p = spark.createDataFrame([("a", 5)], "column_name string, row_count int")
    empty = profiling.save_profile(p.limit(0).selectExpr("*", "'' AS table_name", "current_date() AS profile_date"), p, "t", "2024-01-01")
    twice = profiling.save_profile(empty, p.selectExpr("column_name", "7 AS row_count"), "t", "2024-01-01")
    later = profiling.save_profile(twice, p, "t", "2024-01-02")
    assert twice.count() == 1 and later.count() == 2
    assert [(r.row_count, r.profile_date) for r in profiling.latest_profile(later, "t").collect()] == [(5, date(2024, 1, 2))]
    bad = spark.range(1).selectExpr("assert_true(id > 5) AS x")
    rows = {r.table_name: r for r in profiling.profile_all({"b": bad, "a": p}).where("column_name is null or column_name = 'row_count'").collect()}
    assert rows["a"].row_count == 1 and rows["a"].error is None and rows["b"].error


def test_quantiles(spark):
    df = spark.createDataFrame([(float(i % 7), None) for i in range(50)] + [(None, None)], "x double, y double")
    got = {r.column_name: r.quantiles for r in profiling.quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 1.0]).collect()}
    values = sorted(i % 7 for i in range(50))
    assert got["x"] == [0.0, values[12] + 0.25 * (values[13] - values[12]), 3.0, 6.0] and got["y"] is None


def test_logs_and_catalog(spark):
    found = spark.createDataFrame([("c", "new", "warning")], "column_name string, change string, severity string")
    log = contracts.drift_log(found, "t", "raw", "2024-01-05")
    assert contracts.changes_since(log, "2024-01-05").count() == 1 and contracts.changes_since(log, "2024-01-06").count() == 0
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, o int")
    assert sorted(map(tuple, contracts.latest(df, "k", "o").collect())) == [("a", 3), ("b", 2)]
    df.createOrReplaceTempView("dim_kind")
    assert [(r.table_name, r.row_count) for r in contracts.crawl_catalog(spark).where("table_name = 'dim_kind'").collect()] == [("dim_kind", 3)]


def test_rejected_rows_have_an_index(spark):
    df = spark.createDataFrame([(1, "ok"), (2, '{"a":1}')], "id int, note string").coalesce(1)
    good, bad = rejects.split(df, (rejects.Rule("blob", "json_blob", ("note",)),))
    assert good.columns == ["id", "note"] and [(r.id, r._original_index) for r in bad.collect()] == [(2, 1)]


def test_json_helpers(spark):
    pairs = [
        ('{"a":{"b":1},"n":1}', '{"n":2}', '{"a":{"b":1},"n":2}'),
        ('{"a":{"b":1},"c":"x"}', '{"c":[1,"y",null],"d":null}', '{"a":{"b":1},"c":[1,"y",null],"d":null}'),
        (None, '{"d":2}', '{"d":2}'),
        ("bad", '{"d":2.25}', '{"d":2.25}'),
        ('{"d":true}', "{bad", '{"d":true}'),
        ("[1,{}]", '["x"]', '[1,{},"x"]'),
        ('{"a":1}', "[2]", '[{"a":1},2]'),
        ("1", '"x"', '[1,"x"]'),
        ("", None, None),
        ("{}", "{}", "{}"),
    ]
    df = spark.createDataFrame([(i, *p[:2]) for i, p in enumerate(pairs)], "i int, l string, r string")
    merged = df.select("i", clean.json_merge(df.l, df.r).alias("m")).collect()
    assert [r.m for r in sorted(merged)] == [p[2] for p in pairs]
    text = spark.createDataFrame([('{"a":{"b":[1,"2",{"c":3.5}]},"n":"7","t":true}',), ("[1,[2,3]]",), ("bad",), (None,), ("[]",)], "c string")
    c = text.c
    rows = text.select(
        clean.json_field(c, "a.b[1]").alias("field"), clean.json_value(c, "a.b[2].c", "double").alias("deep"), clean.json_value(c, "n", "int").alias("n"),
        clean.json_value(c, "t", "boolean").alias("t"), clean.json_value(c, "[1][0]", "int").alias("at"), clean.json_value(c, "a.b", "int").alias("misfit"),
        clean.json_length(c).alias("len"), clean.json_length(c, "a.b").alias("inner"), F.to_json(clean.json_value(c, "a", "variant")).alias("kept"),
    ).collect()
    assert tuple(rows[0]) == ("2", 3.5, 7, True, None, None, None, 3, '{"b":[1,"2",{"c":3.5}]}')
    assert tuple(rows[1]) == (None, None, None, None, 2, None, 2, None, None)
    assert [r.len for r in rows] == [None, 2, None, None, 0] and rows[2].field is None


def test_release_removes_what_was_written(spark):
    a = materialize(spark.range(5), "a")
    b = materialize(a.where("id > 2"), "b")
    release(a)
    assert b.count() == 2
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FAILED_READ"):
        a.count()
    assert datetime.now()
