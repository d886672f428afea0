"""Word rules shared by the text operators, as small helpers inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Words are runs of anything but these; str.split() would split at more.
WHITE = " \t\n\x0b\x0c\r"


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; null has none.

    ``bytes.split`` splits at exactly these six ASCII characters.
    """
    return text.encode().split() if text else []


def row_map(
    df: DataFrame,
    fn: Callable[[list], Iterator[tuple]],
    inputs: list[str],
    new: T.StructType,
    keep: list[str] | None = None,
    rows_at_once: int = 512,
) -> DataFrame:
    """Append columns ``new`` that ``fn`` makes from the columns ``inputs``.

    ``fn`` gets a list of tuples (the inputs of a slice of rows) and returns
    as many tuples (the new values), or None for a row to leave out. ``keep``
    names the columns that stay (default: all); a column with the name of a
    new one is replaced. Slices bound the memory of a task whatever the batch.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    picked = list(dict.fromkeys([*keep, *inputs]))
    src = df.select(*[f"`{c}`" for c in picked])
    schema = T.StructType([*[src.schema[c] for c in keep], *new.fields])
    arrow_new = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows_at_once):
                b = whole.slice(at, rows_at_once)
                made = fn(list(zip(*[b.column(picked.index(c)).to_pylist() for c in inputs], strict=True)))
                made = list(made)
                if any(m is None for m in made):
                    b = b.filter(pa.array([m is not None for m in made]))
                    made = [m for m in made if m is not None]
                cols = [pa.array([m[i] for m in made], f.type) for i, f in enumerate(arrow_new)]
                out = [b.column(picked.index(c)) for c in keep] + cols
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return src.mapInArrow(run, schema)
