"""Two outputs compared row by row and cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differences(before: DataFrame, after: DataFrame, key: str = "id_fila") -> DataFrame:
    """`<key>, columna, antes, despues`: the cells in which two outputs with the same unique key differ, as text.

    Rows are aligned by key in one full outer join; a null differs from an empty text. A row that only one side has comes out
    once, with `columna` = `(fila)` and `falta` or `sobra`; so does a column, without a key. Equal outputs give no rows.
    """
    shared = [c for c in before.columns if c in after.columns and c != key]
    side = lambda df, name: df.select(F.col(f"`{key}`").alias(f"__k_{name}"), F.struct(F.lit(1).alias("__here"), *[F.col(f"`{c}`").cast("string").alias(c) for c in shared]).alias(name))
    j = side(before, "a").join(side(after, "b"), F.col("__k_a").eqNullSafe(F.col("__k_b")), "full_outer")
    cell = lambda name, c: F.col(name).getField(c)
    found = [F.when(~cell("a", c).eqNullSafe(cell("b", c)), F.struct(F.lit(c).alias("columna"), cell("a", c).alias("antes"), cell("b", c).alias("despues"))) for c in shared]
    only = lambda a, b: F.struct(F.lit("(fila)").alias("columna"), F.lit(a).cast("string").alias("antes"), F.lit(b).cast("string").alias("despues"))
    lone = F.when(F.col("b").isNull(), F.array(only("falta", None))).when(F.col("a").isNull(), F.array(only(None, "sobra")))
    rows = j.select(F.coalesce("__k_a", "__k_b").alias(key), F.inline(F.coalesce(lone, F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<columna:string,antes:string,despues:string>>"))))
    extra = [(c, "falta", None) for c in before.columns if c not in after.columns] + [(c, None, "sobra") for c in after.columns if c not in before.columns]
    if extra:
        kind = before.schema[key].dataType.simpleString()
        rows = rows.unionByName(before.sparkSession.createDataFrame([(None, *x) for x in extra], f"`{key}` {kind}, columna string, antes string, despues string"))
    return rows
