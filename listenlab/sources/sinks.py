"""Writers: Parquet marts (ZSTD), CSV extracts.

CSV format of the extracts: header row, a byte-order mark before the first
header, floats as ``%.8f``, NULL as an empty field, booleans as
``True``/``False``. Spark writes a folder of part files; small extracts can
be written as one part (``single_file``), which routes the rows through one
task -- only for frames of a few thousand rows at most (day or step grain).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Extract text format.
BOM = "\ufeff"


def write_parquet(df: DataFrame, path: str, sort_keys: list[str] | None = None,
                  total_order: bool = False) -> None:
    """ZSTD Parquet, rows sorted by ``sort_keys``: across files (a range
    shuffle) or within each file (no shuffle). Marts come in order already
    (``operators.metrics.in_order``)."""
    sorted_frame(df, sort_keys, total_order).write.mode("overwrite").option("compression", "zstd").parquet(path)


def sorted_frame(df: DataFrame, sort_keys: list[str] | None, total_order: bool = False) -> DataFrame:
    if not sort_keys:
        return df
    return df.orderBy(*sort_keys) if total_order else df.sortWithinPartitions(*sort_keys)


def _float_text():
    """``%.8f`` of the binary value, rounded half to even, as the original
    writer does it. Spark's ``format_string`` rounds the shortest decimal text
    half up instead (1/512 would end in 13, not 12), and no built-in function
    rounds the binary value, so the text is made in Arrow batches here, at the
    sink. NULL and NaN are empty."""
    @F.pandas_udf("string")
    def text(values: pd.Series) -> pd.Series:
        return values.map(lambda x: "%.8f" % x, na_action="ignore").astype(object).where(values.notna(), None)

    return text


def csv_frame(df: DataFrame) -> DataFrame:
    """All columns rendered as the extract text (see module doc)."""
    cols, float_text = [], _float_text()
    for i, f in enumerate(df.schema.fields):
        c, t = F.col(f"`{f.name}`"), f.dataType.simpleString()
        if t in ("double", "float") or t.startswith("decimal"):
            v = float_text(c.cast("double"))
        elif t == "boolean":
            v = F.initcap(c.cast("string"))
        else:
            v = c.cast("string")
        cols.append(v.alias((BOM if i == 0 else "") + f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    write_csv_text(csv_frame(df), path, single_file)


def write_csv_text(out: DataFrame, path: str, single_file: bool = False) -> None:
    """Write what ``csv_frame`` has rendered."""
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
