import random
import sqlite3
import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import contracts, expectations, ingest, profiling, rejects, warehouse
from tarnlake.sources import database, landing

AT = datetime(2024, 2, 1)
R = expectations.QualityRule


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- sources ------------------------------------------------------------------


@pytest.fixture(scope="module")
def shop(tmp_path_factory):
    shards = []
    for i in range(2):
        path = str(tmp_path_factory.mktemp("db") / f"{i}.db")
        base = sqlite3.connect(path)
        base.execute("CREATE TABLE leads (id bigint, name text, budget double, note text NOT NULL DEFAULT 'x')")
        base.executemany("INSERT INTO leads VALUES (?, ?, ?, 'n')", [(k if k % 10 else None, f"l{k}" if k % 3 else None, k / 2) for k in range(i * 100, i * 100 + 100)])
        base.execute("CREATE TABLE empty (id bigint)")
        base.commit()
        base.close()
        shards.append({"database": path})
    return database.Database("sqlite3", shards)


def test_database_table_in_ranges(spark, shop):
    df = shop.table(spark, "leads", "id", 4)
    assert df.count() == 200 == shop.count("leads") and df.where("id is null").count() == 20
    assert df.rdd.getNumPartitions() == 2 * 5  # four ranges and the null keys of each shard
    assert {r.id for r in df.where("id is not null").collect()} == {k for k in range(200) if k % 10}
    assert shop.table(spark, "leads").count() == 200 and shop.table(spark, "empty", "id", 3).count() == 0
    assert shop.table(spark, "leads", "name", 4).count() == 200  # a text key: one range
    assert shop.tables() == ["empty", "leads"]
    columns = shop.columns(spark, "leads").collect()
    assert [(c.column_name, c.data_type, c.is_nullable, c.ordinal_position) for c in columns][3] == ("note", "text", "NO", 4)


def test_filters_travel_with_the_query(spark, shop):
    options = {"driver": "sqlite3", "shards": "[{}]", "table": "leads"}
    df = shop.table(spark, "leads", "id", 2)
    reader = database.DatabaseReader(df.schema, options)
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

    left = list(reader.pushFilters([EqualTo(("name",), "a'b"), GreaterThan(("id",), 5), In(("id",), (1, 2)), IsNotNull(("note",)), StringContains(("name",), "x"), EqualTo(("id",), AT)]))
    assert [type(f).__name__ for f in left] == ["StringContains", "EqualTo"]
    assert reader.pushed == [('"name" = ?', ("a'b",)), ('"id" > ?', (5,)), ('"id" IN (?, ?)', (1, 2)), ('"note" IS NOT NULL', ())]
    picked = df.where("id > 150 and budget < 80 and name is not null")
    assert rows(picked.select("id")) == sorted(((k,) for k in range(151, 160) if k % 10 and k % 3), key=repr)
    assert shop.changed(spark, "leads", "budget >= 99").count() == 2
    assert shop.query(spark, "SELECT count(*) AS n FROM leads WHERE id > 50", "n bigint").agg(F.sum("n")).first()[0] == 135


def test_shards_written_by_tasks(spark, tmp_path):
    df = spark.range(20).select("id", F.lit("a").alias("v"), F.lit("2024-01-01").cast("timestamp").alias("at")).repartition(3)
    db = database.write_shards(df, str(tmp_path / "d"), "t", "id")
    assert len(db.shards) == 3 and db.table(spark, "t", "id", 2).where("at = '2024-01-01 00:00:00'").count() == 20
    none = database.write_shards(df.where("id < 0").coalesce(1), str(tmp_path / "e"), "t", "id")
    assert none.table(spark, "t", "id", 2).count() == 0


def test_observed_load_reads_its_source_once(spark, tmp_path):
    """A source that gives other rows each time it is read: what is reported is
    what was written."""
    reads = spark.sparkContext.accumulator(0)

    def count(x):
        reads.add(1)
        return x

    noted = F.udf(count, "long")
    source = spark.range(50, numPartitions=1).select(noted("id").alias("id"), (F.lit(1_700_000_000) + F.col("id") + (F.rand() * 1e6).cast("long")).cast("timestamp").alias("at"))
    done = ingest.full_load(source, ingest.SourceTable("s", "t", tracking="at"), str(tmp_path), AT, "parquet")
    written = spark.read.parquet(done["path"])
    assert reads.value == 50 and done["rows"] == 50
    assert done["watermark"] == written.agg(F.max("at")).first()[0]
    none = ingest.cdc_load(source.where("id < 0"), ingest.SourceTable("s", "u", tracking="at"), str(tmp_path), AT, datetime(2024, 1, 1))
    assert none["rows"] == 0 and none["path"] is None and none["watermark"] == datetime(2024, 1, 1)
    assert not (tmp_path / "s/raw_u/cdc/20240201_000000").exists()
    landing.remove(spark, f"{tmp_path}/nowhere")


def test_tables_run_side_by_side(spark):
    seen, both, lock = {}, threading.Barrier(2, timeout=60), threading.Lock()

    def load(t):
        if t.name != "bad":
            both.wait()  # passes only when two loads are under way at once
        with lock:
            seen[t.name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        if t.name == "bad":
            raise ValueError("no such table")
        return {"table": t.name, "status": "success", "rows": spark.range(7).where("id > 1").count()}

    tables = [ingest.SourceTable("s", n) for n in ("a", "bad", "b")]
    done = ingest.run_tables(tables, load, spark, at_once=3)
    assert [r["table"] for r in done["results"]] == ["a", "bad", "b"] and done["failed"] == 1 and done["rows"] == 10
    assert seen == {"a": "s.a", "bad": "s.bad", "b": "s.b"}
    began = time.time()
    assert ingest.run_tables(tables[1:2], load)["failed"] == 1 and time.time() - began < 30


# -- snapshots ----------------------------------------------------------------


def test_snapshot_changes_with_nulls_and_repeats(spark):
    shape = "id int, v string, n double"
    old = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", None), (4, "d", 4.0), (None, "z", 0.0), (6, "f", float("nan"))], shape)
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, None), (5, "e", 5.0), (5, "e", 5.0), (None, "y", 1.0), (6, "f", float("nan"))], shape)
    found = ingest.snapshot_changes(old, new, "id")
    assert rows(found) == sorted([("U", 2, "b", None, ["v", "n"]), ("U", 3, None, None, ["v"]), ("D", 4, "d", 4.0, None), ("I", 5, "e", 5.0, None)], key=repr)
    assert ingest.snapshot_changes(new, new, "id").count() == 0
    assert {r.op for r in ingest.snapshot_changes(old.limit(0), new, ["id"]).collect()} == {"I"}
    back = ingest.apply_snapshot(old.where("id is not null"), found, "id")
    assert repr(rows(back)) == repr(rows(new.where("id is not null").distinct()))
    more = ingest.snapshot_changes(old, new.withColumn("w", F.lit("k")), "id").where("id = 1").first()
    assert (more.op, more.changed_columns, more.w) == ("U", ["w"], "k")


# -- rules --------------------------------------------------------------------


def test_rules_agree_with_each_alone(spark):
    df = spark.createDataFrame([(1, 5.0, "a", 10), (2, None, "b", 11), (2, -1.0, '{"a":1}', None), (3, 700.0, None, 99), (3, 1.0, "12", 10)], "id int, price double, note string, parent int")
    parents = {"p": spark.createDataFrame([(10,), (11,)], "k int")}
    rules = [
        R("n", "null_check", "note"), R("r", "range_check", "price", {"min": 0, "max": 100}), R("s", "range_check", "price", {"min": 0, "allow_null": False}),
        R("x", "regex_check", "note", {"pattern": "^[a-z]$"}), R("t", "type_check", "note", {"type": "int"}), R("j", "type_check", "note", {"type": "string", "disallow_json": True}),
        R("u", "uniqueness_check", "id"), R("f", "referential", "parent", {"table": "p", "key": "k"}), R("c", "custom_sql", None, {"condition": "price > 0"}), R("m", "null_check", "missing"),
    ]
    got = {r.rule: r for r in expectations.run_rules(df, rules, parents, samples=2).collect()}
    assert {n: r.failed for n, r in got.items()} == {"n": 1, "r": 2, "s": 2, "x": 2, "t": 3, "j": 1, "u": 4, "f": 1, "c": 2, "m": 5}
    for r in rules[:-1]:
        bad = sorted(x[0] for x in expectations.failing(df, r, parents).select(F.to_json(F.struct("*"))).collect())
        assert got[r.name].samples == bad[:2] and got[r.name].failed == len(bad) == got[r.name].checked - got[r.name].passed
    assert got["m"].samples == [] and got["u"].pass_rate == 20.0
    assert {(r.failed, r.pass_rate) for r in expectations.run_rules(df.limit(0), rules, parents).collect()} == {(0, 100.0)}
    assert expectations.run_rules(df, []).count() == 0
    with pytest.raises(ValueError):
        expectations.run_rules(df, [R("q", "guess", "id")])


def test_row_rules_cost_one_pass(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rules = [R(f"r{i}", "range_check", "o_totalprice", {"min": i}) for i in range(20)]
    plan = expectations.run_rules(df, rules, samples=0)._jdf.queryExecution().executedPlan().toString()
    # Counted once; the plan names the scan again for the number of rows beside each rule.
    assert plan.count("FileScan parquet") <= 2


# -- profiles, lineage, catalogs ----------------------------------------------


def test_merged_sketches_against_exact_figures(spark):
    rnd = random.Random(2)
    data = [(i % 7, rnd.gauss(0, 1), f"u{rnd.randrange(900)}", None if i % 5 else i, [1]) for i in range(6000)] + [(0, float("nan"), None, None, None)]
    df = spark.createDataFrame(data, "day int, v double, u string, s int, nested array<int>")
    parts = profiling.sketch_columns(df, F.col("day"))
    assert parts.select("part").distinct().count() == 7 and set(parts.columns) == {c.split()[0] for c in profiling.SKETCH.split(", ")}
    got = {r.column_name: r for r in profiling.sketched_profile(profiling.merge_sketches(parts)).collect()}
    assert set(got) == {"day", "v", "u", "s"}
    values = sorted(r[1] for r in data if r[1] == r[1])
    assert (got["v"].row_count, got["v"].null_count, got["v"].low, got["v"].high) == (6001, 0, values[0], values[-1])
    for q, x in zip((0.25, 0.5, 0.75), got["v"].quantiles, strict=True):
        assert abs(sum(y <= x for y in values) / len(values) - q) < 0.03
    assert got["u"].quantiles == [None] * 3 and abs(got["u"].distinct_estimate - len({r[2] for r in data} - {None})) < 50
    assert got["s"].null_count == 4801 and got["s"].null_pct == 80.0
    again = profiling.merge_sketches(parts.where("part < 3").unionByName(parts.where("part >= 3")))
    assert {r.column_name: r.row_count for r in again.collect()} == {c: 6001 for c in got}
    assert profiling.sketch_columns(df.limit(0), F.col("day")).count() == 0


def test_lineage_without_a_depth(spark):
    chain = [(f"a{i}", f"a{i + 1}") for i in range(200)]
    edges = spark.createDataFrame([*chain, ("x", "a150"), ("a200", "y"), (None, "a3")], "source string, target string")
    got = {r.asset: r.distance for r in contracts.upstream(edges, "a200").collect()}
    assert got == {f"a{i}": 200 - i for i in range(200)} | {"x": 51}
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "b")], "source string, target string")
    assert {r.asset: r.distance for r in contracts.upstream(ring, "d").collect()} == {"c": 1, "b": 2, "a": 3}
    assert {r.asset: r.distance for r in contracts.upstream(ring, "a").collect()} == {"c": 1, "b": 2}
    closure = {(r.source, r.target): r.distance for r in contracts.lineage_closure(ring).collect()}
    assert closure["a", "a"] == 3 and closure["a", "d"] == 3 and len(closure) == 12
    assert contracts.upstream(ring, "nothing").count() == 0 and contracts.lineage_closure(ring.limit(0)).count() == 0


def test_every_database_type():
    for name, want in contracts.DATABASE_TYPES.items():
        assert contracts.database_type(name.upper()) == want
    assert contracts.database_type("time without time zone") == "time" == contracts.database_type("Time(6) with time zone")
    assert contracts.database_type("timestamp(3) without time zone") == "timestamp" and contracts.database_type("numeric(10, 2)") == "decimal"
    assert contracts.database_type("point") == "string" and contracts.database_type("integer") == "integer"


def test_footers_answer_counts(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("p"))
    df.write.partitionBy("p").parquet(f"{tmp_path}/t")
    df.limit(0).write.parquet(f"{tmp_path}/none")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = contracts.crawl_footers(spark, str(tmp_path), ["t", "none"], {"t": ["p"]})
    assert rows(got) == sorted([("t", "p=0", 34), ("t", "p=1", 33), ("t", "p=2", 33), ("none", "", 0)], key=repr)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_warehouse_columns_and_keys(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS fact_visit (visit_sk BIGINT, day DATE, n INT) USING parquet PARTITIONED BY (day)")
    try:
        got = {r.column_name: (r.asset_type, r.data_type, r.is_key) for r in contracts.crawl_warehouse(spark, ("fact_visit",)).collect()}
        assert got == {"visit_sk": ("fact", "bigint", True), "n": ("fact", "int", False), "day": ("fact", "date", True)}
    finally:
        spark.sql("DROP TABLE fact_visit")


def test_run_tables(spark, tmp_path):
    run = {"run_id": "1", "pipeline_name": "p", "status": "success", "start_time": AT, "records_read": 5}
    contracts.record_run(spark, str(tmp_path), run, [])
    contracts.record_run(spark, str(tmp_path), run | {"run_id": "2", "status": "failed", "start_time": datetime(2024, 3, 1)}, [{"task_name": "t", "status": "failed", "records_processed": 3}])
    got = contracts.run_history(spark, str(tmp_path)).collect()
    assert [(r.run_id, r.tasks, r.failed_tasks, r.seconds) for r in got] == [("2", 1, 1, None), ("1", 0, 0, None)]


def test_rejections_and_drift_leave_their_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "id int, v string")
    rules = (rejects.Rule("b", "regex", ("v",), "^bad$"),)
    (row,) = rejects.rejection_log(rejects.totals(df, rules), rejects.summary(df, rules), "t", "2024-01-01").collect()
    assert row.message == "Rejected 1/3 records (33.33%)" and '"rules":[{"rule":"b"' in row.log_metadata
    assert rejects.rejection_log(rejects.totals(df.limit(1), rules), rejects.summary(df.limit(1), rules), "t", "2024-01-01").count() == 0
    names = lambda *x: spark.createDataFrame([(c,) for c in x], "column_name string")
    got = {r.name: r.value for r in contracts.drift_metrics(contracts.integrity(names("a", "b"), names("b", "c", "d")), "t", "2024-01-01").collect()}
    assert got == {"schema_integrity_score": 30.0, "schema_new_columns_count": 2.0, "schema_missing_columns_count": 1.0}


def test_dimensions_of_a_load_in_one_pass(spark):
    staged = spark.createDataFrame([(" a ", 1), ("b", 2), ("a", None), (None, 1), ("", 3)], "k string, n int")
    dims = warehouse.load_dimensions(staged, {"x": ("k", "kk", "x_sk"), "y": ("n", "nn", "y_sk")}, "2024-01-01", {"y": F.col("n") < 3})
    assert sorted((r.kk, r.x_sk) for r in dims["x"].collect()) == [("-1", -1), ("a", 1), ("b", 2)]
    assert sorted((r.nn, r.y_sk, r.is_current) for r in dims["y"].collect()) == [("-1", -1, True), ("1", 1, True), ("2", 2, True)]
    empty = warehouse.load_dimensions(staged.limit(0), {"x": ("k", "kk", "x_sk")}, "2024-01-01")
    assert [r.x_sk for r in empty["x"].collect()] == [-1]
    two = warehouse.load_from_sources(warehouse.empty_dimension(spark, "k", "k_sk", ["a"]), [spark.createDataFrame([("p", "1")], "k string, a string"), spark.createDataFrame([("p", "9"), ("q", "2")], "k string, a string")], "k", "k_sk", "2024-01-01", ["a"])
    assert sorted((r.k, r.a, r.k_sk) for r in two.collect()) == [("p", "1", 1), ("q", "2", 2)]


def test_pass_rates_round_as_in_sql(spark):
    some = spark.range(20000).select(F.when(F.col("id") < 201, 1).alias("v"))  # 1.005 %, a little less as a double
    assert expectations.run_rules(some, [R("n", "null_check", "v")], samples=0).first().pass_rate == 1.0
