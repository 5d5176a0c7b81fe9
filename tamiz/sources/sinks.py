"""Byte-exact ordered CSV files and the Markdown sinks (K1-K3, K6)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv_field(c: Column, is_bool: bool = False) -> Column:
    """Text of a value: TRUE/FALSE, '' for null; quoted only if it holds a comma, quote or line break."""
    s = F.coalesce(F.upper(c.cast("string")) if is_bool else c.cast("string"), F.lit(""))
    return F.when(s.rlike('[,"\\n\\r]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def csv_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(F.concat_ws(",", *[csv_field(F.col(f"`{c}`"), kinds[c] == "boolean") for c in columns]).alias("linea"))


def write_csv(df: DataFrame, columns: list[str], path: str) -> int:
    """Write the rows of `df`, in its order, as UTF-8 with BOM, LF and a header; gives the number of rows.

    Lines are rendered by the executors and streamed partition by partition, so the driver never holds the table.
    The file appears only when it is whole.
    """
    n = 0
    part = f"{path}.part"
    with open(part, "w", encoding="utf-8", newline="") as out:
        out.write("﻿" + ",".join(columns) + "\n")
        for row in csv_lines(df, columns).toLocalIterator(prefetchPartitions=True):
            out.write(row[0] + "\n")
            n += 1
    os.replace(part, path)
    return n


def write_partitioned_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """The same lines in the same order as part files in `path`/filas, written by the executors, and the header in
    `path`/encabezado; for tables beyond one machine. Joined in the order of their names the parts are the single file."""
    lines = csv_lines(df, columns)
    lines.write.mode("overwrite").text(f"{path}/filas")
    df.sparkSession.createDataFrame([(",".join(columns),)], "linea string").coalesce(1).write.mode("overwrite").text(f"{path}/encabezado")


def write_text(text: str, path: str) -> None:
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
