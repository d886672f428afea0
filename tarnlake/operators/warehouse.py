"""Star schema: dimensions, surrogate keys, history, facts, upserts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnlake.functions import clean

UNKNOWN = -1
FOREVER = "9999-12-31"


def date_dimension(spark: SparkSession, first: str = "2015-01-01", last: str = "2030-12-31") -> DataFrame:
    """One row per day with its calendar parts; date_sk is yyyyMMdd."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 1 DAY)) AS date_actual")
    key = F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_sk")
    return days.select(key, "date_actual", *[c.alias(n) for n, c in clean.calendar(F.col("date_actual")).items()])


def number_rows(df: DataFrame, order: list[str], name: str, start: Column | int = 0) -> DataFrame:
    """Gapless numbers in ``order`` without a global window over the rows.

    Rows are range-partitioned and sorted; numbers inside a partition get the
    offset of the partitions before it (one count per partition). The rows are
    written first: the partition of a row must not change between the passes.
    """
    from tarnlake.session import materialize

    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "numbered")
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    nth = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    numbered = dealt.withColumn("_nth", nth).join(shift, "_part")
    return numbered.withColumn(name, (F.col("_nth") + F.col("_shift") + start).cast("long")).drop("_part", "_nth", "_shift")


def new_members(source: DataFrame, current: DataFrame, key: str, attributes: list[str] | None = None) -> DataFrame:
    """Distinct trimmed non-blank keys that no current row has, one row each.

    Where a key comes with several attribute values the least row is taken, so
    facts never fan out.
    """
    attributes = attributes or []
    trimmed = source.select(F.trim(key).alias(key), *attributes).where(clean.not_blank(F.col(key)))
    one = trimmed.groupBy(key).agg(F.min(F.struct(*attributes)).alias("_a")).select(key, "_a.*") if attributes else trimmed.distinct()
    return one.join(current.where("is_current").select(key), key, "left_anti")


def load_dimension(current: DataFrame, source: DataFrame, key: str, surrogate: str, effective: str, attributes: list[str] | None = None) -> DataFrame:
    """``current`` plus the new members with the next surrogate keys."""
    top = current.agg(F.coalesce(F.greatest(F.max(surrogate), F.lit(0)), F.lit(0))).first()[0]
    added = number_rows(new_members(source, current, key, attributes), [key], surrogate, top)
    added = added.withColumns(
        {"is_current": F.lit(True), "effective_from": F.lit(effective).cast("date"), "effective_to": F.lit(FOREVER).cast("date")}
    )
    return current.unionByName(added, allowMissingColumns=True)


def load_from_sources(
    current: DataFrame, sources: list[DataFrame], key: str, surrogate: str, effective: str, attributes: list[str] | None = None
) -> DataFrame:
    """A dimension fed by several sources in order: a later one adds the members
    that none before it knows, with the attributes it gives them."""
    for source in sources:
        current = load_dimension(current, source, key, surrogate, effective, attributes)
    return current


def load_dimensions(
    staged: DataFrame, specs: dict[str, tuple[str, str, str]], effective: str, where: dict[str, Column] | None = None
) -> dict[str, DataFrame]:
    """First load of several dimensions, all from one pass over the staged rows.

    ``specs`` names for each dimension the staged column, its key and its
    surrogate; ``where`` limits the rows of some. The distinct (dimension,
    member) pairs come from one aggregate and are numbered by one sort; every
    dimension's numbers start at 1 in key order. Unknown members are added.
    """
    from tarnlake.session import materialize

    limits = where or {}
    of = lambda n, c: F.when(limits.get(n, F.lit(True)), F.trim(F.col(c).cast("string")))
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), of(n, c).alias("member")) for n, (c, _, _) in specs.items()])
    members = staged.select(F.explode(pairs).alias("p")).select("p.*").where(clean.not_blank(F.col("member"))).distinct()
    numbered = materialize(number_rows(members, ["dimension", "member"], "nth"), "members")
    first = numbered.groupBy("dimension").agg(F.min("nth").alias("first"))
    placed = numbered.join(first, "dimension").select("dimension", "member", (F.col("nth") - F.col("first") + 1).alias("sk"))
    marks = [F.lit(True).alias("is_current"), F.lit(effective).cast("date").alias("effective_from"), F.lit(FOREVER).cast("date").alias("effective_to")]
    found = {}
    for n, (_, key, surrogate) in specs.items():
        dim = placed.where(F.col("dimension") == n).select(F.col("member").alias(key), F.col("sk").alias(surrogate), *marks)
        found[n] = _and_unknown(dim, surrogate, key)
    return found


def with_unknown(dim: DataFrame, surrogate: str, key: str, effective: str = "1900-01-01") -> DataFrame:
    """Add the unknown member (-1) unless it is there."""
    if dim.where(F.col(surrogate) == UNKNOWN).limit(1).count():
        return dim
    return _and_unknown(dim, surrogate, key, effective)


def _and_unknown(dim: DataFrame, surrogate: str, key: str, effective: str = "1900-01-01") -> DataFrame:
    values = {surrogate: UNKNOWN, key: "-1", "is_current": True}
    row = dim.sparkSession.range(1).select(
        *[
            F.lit(values[f.name]).cast(f.dataType).alias(f.name)
            if f.name in values
            else F.lit({"effective_from": effective, "effective_to": FOREVER}.get(f.name, "Unknown" if f.dataType.simpleString() == "string" else None))
            .cast(f.dataType)
            .alias(f.name)
            for f in dim.schema
        ]
    )
    return dim.unionByName(row)


def empty_dimension(spark: SparkSession, key: str, surrogate: str, attributes: list[str] | None = None) -> DataFrame:
    more = "".join(f", {a} string" for a in attributes or [])
    return spark.createDataFrame([], f"{key} string{more}, {surrogate} long, is_current boolean, effective_from date, effective_to date")


@dataclass
class Lookup:
    """A dimension lookup: fact column -> surrogate key column."""

    dim: DataFrame
    column: str
    key: str
    surrogate: str
    target: str | None = None


def look_up(fact: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Left-join the current rows of each dimension on the trimmed key; what is
    not found gets the unknown member. Spark broadcasts a dimension when its
    size allows and shuffles it otherwise."""
    for i, l in enumerate(lookups):
        found = F.col(l.surrogate).alias(f"_s{i}")
        dim = l.dim.where("is_current").select(F.col(l.key).cast("string").alias(f"_k{i}"), found)
        fact = fact.join(dim, F.trim(F.col(l.column).cast("string")) == F.col(f"_k{i}"), "left")
        fact = fact.withColumn(l.target or l.surrogate, F.coalesce(f"_s{i}", F.lit(UNKNOWN))).drop(f"_k{i}", f"_s{i}")
    return fact


def look_up_dates(fact: DataFrame, dates: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One date dimension in several roles: {timestamp column: key column}."""
    for i, (c, target) in enumerate(columns.items()):
        role = dates.select(F.col("date_actual").alias(f"_d{i}"), F.col("date_sk").alias(target))
        fact = fact.join(role, F.col(c).cast("date") == F.col(f"_d{i}"), "left").drop(f"_d{i}")
    return fact


def replace_by_key(existing: DataFrame, incoming: DataFrame, key: str | list[str]) -> DataFrame:
    """Delete the incoming keys, then insert: a second run changes nothing."""
    keys = [key] if isinstance(key, str) else key
    return existing.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming, allowMissingColumns=True)


def insert_missing(existing: DataFrame, incoming: DataFrame, key: str | list[str]) -> DataFrame:
    """Insert rows whose key is new; rows in place stay."""
    keys = [key] if isinstance(key, str) else key
    return existing.unionByName(incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Rows that meet the condition get new values; NULL conditions do not."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def fact_leads(staged: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows of leads: looked-up keys, typed measures and a record hash.

    ``dims``: date, status, source, type, agent, area, campaign.
    """
    live = staged.where(F.col("op") != "D") if "op" in staged.columns else staged
    budget = F.col("budget").cast("decimal(15,2)")
    facts = look_up(
        live,
        [
            Lookup(dims["status"], "lead_status", "status_name", "lead_status_sk"),
            Lookup(dims["source"], "lead_source", "source_name", "lead_source_sk"),
            Lookup(dims["type"], "lead_type", "type_name", "lead_type_sk"),
            Lookup(dims["agent"], "agent_id", "agent_id", "agent_sk"),
            Lookup(dims["area"], "area_id", "area_id", "area_sk"),
            Lookup(dims["campaign"], "campaign", "campaign_name", "campaign_sk"),
        ],
    )
    roles = {"lead_created_at": "created_date_sk", "lead_updated_at": "updated_date_sk", "date_of_last_contact": "last_contact_date_sk"}
    facts = look_up_dates(facts, dims["date"], roles)
    digest = clean.record_hash(F.col("lead_id"), F.col("lead_status"), budget, F.col("lead_updated_at").cast("date"))
    flags = ["is_buyer", "is_seller", "is_commercial", "is_merged", "has_meeting", "do_not_call"]
    keys = ["lead_status_sk", "lead_source_sk", "lead_type_sk", "agent_sk", "area_sk", "campaign_sk", *roles.values()]
    return facts.select("lead_id", *keys, "customer_id", "location", "contact_method", budget.alias("budget"), *flags, digest.alias("record_hash"))


def fact_sales(staged: DataFrame, leads: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows of sales with the surrogate key of their lead (-1: none).

    The lead join is a plain equi-join of two large sides; ``leads`` has
    lead_id and lead_sk, one row per lead. ``dims``: date, property, area, category.
    """
    live = staged.where(F.col("op") != "D") if "op" in staged.columns else staged
    facts = live.join(leads.select("lead_id", "lead_sk"), "lead_id", "left").withColumn("lead_sk", F.coalesce("lead_sk", F.lit(UNKNOWN)))
    facts = look_up(
        facts,
        [
            Lookup(dims["property"], "property_type", "type_name", "property_type_sk"),
            Lookup(dims["area"], "area_id", "area_id", "area_sk"),
            Lookup(dims["category"], "sale_category", "category_name", "sale_category_sk"),
        ],
    )
    roles = {"sale_date": "reservation_date_sk", "reservation_update_date": "update_date_sk", "contract_date": "contract_date_sk"}
    facts = look_up_dates(facts, dims["date"], roles)
    money = [F.col(c).cast("decimal(15,2)").alias(c) for c in ("unit_value", "expected_value", "actual_value")]
    digest = clean.record_hash(F.col("sale_id"), F.col("lead_id"), F.col("actual_value").cast("decimal(15,2)"), F.col("sale_category"))
    keys = ["property_type_sk", "area_sk", "sale_category_sk", *roles.values()]
    return facts.select("sale_id", "lead_id", "lead_sk", *keys, *money, "unit_location", "payment_years", digest.alias("record_hash"))


def apply_history(dim: DataFrame, incoming: DataFrame, key: str, surrogate: str, attributes: list[str], effective: str) -> DataFrame:
    """SCD type 2: changed keys close their current row and open a new one.

    Unchanged keys keep their row, new keys open one, keys that no longer come
    stay current. A second run with the same input changes nothing.
    """
    digest = clean.record_hash(*[F.col(a) for a in attributes])
    come = incoming.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*attributes)).alias("_a")).select(key, "_a.*")
    come = come.withColumn("_new", digest)
    now = dim.where("is_current").select(key, digest.alias("_old"))
    opened = come.join(now, key, "left").where(F.col("_old").isNull() | (F.col("_old") != F.col("_new"))).drop("_old", "_new")
    day = F.lit(effective).cast("date")
    closed = dim.join(opened.select(key, F.lit(True).alias("_changed")), key, "left")
    closed = update_where(closed, F.col("is_current") & F.col("_changed"), {"effective_to": day, "is_current": F.lit(False)}).drop("_changed")
    top = dim.agg(F.coalesce(F.greatest(F.max(surrogate), F.lit(0)), F.lit(0))).first()[0]
    rows = number_rows(opened, [key], surrogate, top)
    rows = rows.withColumns({"is_current": F.lit(True), "effective_from": day, "effective_to": F.lit(FOREVER).cast("date")})
    return closed.unionByName(rows, allowMissingColumns=True)


def history(changes: DataFrame, key: str, at: str) -> DataFrame:
    """Versions of each key from its dated changes; a day's last row counts."""
    w = W.partitionBy(key).orderBy(at)
    until = F.coalesce(F.lead(at).over(w), F.lit(FOREVER).cast("date"))
    return changes.withColumns({"effective_from": F.col(at), "effective_to": until, "is_current": F.lead(at).over(w).isNull()})


def load_log(spark: SparkSession, batch: str, tables: dict[str, DataFrame], started: str, ended: str) -> DataFrame:
    """One row per loaded table with its row count."""
    shape = [
        df.agg(F.count(F.lit(1)).alias("records_loaded")).select(
            F.lit(batch).alias("batch_id"), F.lit(name).alias("table_name"), "records_loaded", F.lit("success").alias("load_status"),
            F.lit(started).cast("timestamp").alias("start_time"), F.lit(ended).cast("timestamp").alias("end_time"),
        )
        for name, df in tables.items()
    ]
    out = shape[0]
    for s in shape[1:]:
        out = out.unionByName(s)
    return out


def run_steps(steps: list[tuple[str, Callable[[], None]]]) -> list[str]:
    """Run named steps in order; the first failure stops the job and surfaces."""
    done = []
    for name, step in steps:
        try:
            step()
        except Exception as e:
            raise RuntimeError(f"step {name} failed after {done}") from e
        done.append(name)
    return done
