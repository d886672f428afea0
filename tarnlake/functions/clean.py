"""Scalar cleaning functions as column expressions; failures give NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp patterns, tried in this order.
TIMESTAMP_PATTERNS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "d/M/yyyy H:mm",
    "d/M/yyyy",
)
# Boolean words.
TRUE_WORDS = ("TRUE", "1", "YES", "Y", "T")
FALSE_WORDS = ("FALSE", "0", "NO", "N", "F")
# Status names and what they become.
STATUS = {
    "NEW": "NEW",
    "CONTACTED": "CONTACTED",
    "QUALIFIED": "QUALIFIED",
    "CONVERTED": "CONVERTED",
    "LOST": "LOST",
    "NOT INTERESTED": "NOT_INTERESTED",
    "NOT_INTERESTED": "NOT_INTERESTED",
    "SWITCHED OFF": "UNREACHABLE",
    "NO ANSWER": "UNREACHABLE",
    "WRONG NUMBER": "UNREACHABLE",
    "DELETED": "DELETED",
}
# Text that stands for a missing value in delimited files.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def strip(c: Column) -> Column:
    """Trim any white space, not only spaces."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def null_words(c: Column) -> Column:
    return F.when(~c.isin(*NULL_WORDS), c)


def parse_timestamp(c: Column, pattern: str | None = None) -> Column:
    patterns = TIMESTAMP_PATTERNS if pattern is None else (pattern,)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in patterns])


def parse_boolean(c: Column) -> Column:
    word = F.upper(strip(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def clean_string(c: Column) -> Column:
    return F.nullif(F.regexp_replace(strip(c), r"\s+", " "), F.lit(""))


def normalize_status(c: Column) -> Column:
    name = F.upper(strip(c))
    table = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), F.regexp_replace(name, " ", "_"), F.lit("UNKNOWN"))


def parse_numeric(c: Column) -> Column:
    return F.regexp_replace(c, "[,$ ]", "").try_cast("double")


def record_hash(*cols: Column) -> Column:
    """MD5 of the fields joined by '|', NULL as ''. Give decimals, not doubles:
    engines print doubles differently."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def alert_key(kind: Column, source: Column, title: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", kind, source, title), 256), 1, 32)


def looks_like_json(c: Column) -> Column:
    """Brackets on both ends."""
    return c.rlike(r"(?s)^\s*(\{.*\}|\[.*\])\s*$")


def is_json_blob(c: Column) -> Column:
    """Brackets on both ends and one valid JSON document; NULL is none."""
    one = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    return F.coalesce(looks_like_json(c) & F.try_parse_json(c).isNotNull() & one, F.lit(False))


def json_field(c: Column, path: str) -> Column:
    """A field of a JSON text by its dotted path, as text; NULL if there is none."""
    return F.get_json_object(c, f"$.{path}")


def json_value(c: Column, path: str, kind: str) -> Column:
    """A value of a JSON text by its path (``a.b[0]``) as the SQL type ``kind``;
    NULL if there is none, it does not fit the type, or the text is not JSON.
    ``variant`` keeps numbers, objects and arrays as they are."""
    return F.try_variant_get(F.try_parse_json(c), f"${path}" if path.startswith("[") else f"$.{path}", kind)


def json_length(c: Column, path: str | None = None) -> Column:
    """Elements of a JSON array, or of the array at ``path``; NULL if it is none."""
    parsed = F.try_parse_json(c)
    place = "$" if path is None else f"${path}" if path.startswith("[") else f"$.{path}"
    return F.nullif(F.size(F.try_variant_get(parsed, place, "array<variant>")), F.lit(-1))


def json_merge(a: Column, b: Column) -> Column:
    """Two JSON documents as one, values as they are: of objects the fields of
    the second win, arrays are joined, anything else joins as an element. A side
    that is NULL or not JSON leaves the other; both: NULL. Fields come sorted."""
    left, right = F.try_parse_json(a), F.try_parse_json(b)
    fields = [F.try_variant_get(x, "$", "map<string,variant>") for x in (left, right)]
    items = [F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array(x)) for x in (left, right)]
    kept = F.map_filter(fields[0], lambda k, _: ~F.map_contains_key(fields[1], k))
    objects = F.to_variant_object(F.map_concat(kept, fields[1]))
    joined = F.when(fields[0].isNotNull() & fields[1].isNotNull(), objects).otherwise(F.to_variant_object(F.concat(*items)))
    return F.to_json(F.when(left.isNull(), right).when(right.isNull(), left).otherwise(joined))


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def live(op: Column) -> Column:
    """Not a delete; rows without an operation count as live."""
    return ~op.eqNullSafe(F.lit("D"))


def calendar(date: Column) -> dict[str, Column]:
    """Calendar parts of a date; Sunday is day 0 of the week, weeks are ISO."""
    day = F.dayofweek(date) - 1
    return {
        "year": F.year(date),
        "quarter": F.quarter(date),
        "month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "week": F.weekofyear(date),
        "day": F.dayofmonth(date),
        "day_of_week": day,
        "day_name": F.date_format(date, "EEEE"),
        "is_weekend": day.isin(0, 6),
    }


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def rounded(c: Column, digits: int = 2) -> Column:
    """A double rounded as SQL engines round doubles: the scaled number goes to
    the nearest whole, halves away from zero. Spark's own rounds the number as it
    prints, so that 1.005, which lies below the half, goes up."""
    return F.round(c * 10.0**digits) / 10.0**digits


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds that the clock moves on, as SQL's ``date_diff`` counts them: from
    00:00:00.9 to 00:00:02.1 two, where Spark counts whole seconds gone by."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = [F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz")) for c in (start, end)]
    a, b = [m - F.pmod(m, F.lit(1_000_000)) for m in micros]
    return ((b - a) / 1_000_000).cast("long")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part * 100.0 / F.nullif(whole, F.lit(0)), digits)
