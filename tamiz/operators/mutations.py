"""How many single-digit typos a check-digit rule lets through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.taxid import taxid_valid


def mutations(ids: DataFrame, column: str = "cuil_norm") -> DataFrame:
    """Every valid id with one of its eleven digits replaced by each of the other nine: `original, mutado`.

    Ninety-nine rows an id, made by a generator, not by a join; ids that aren't valid are left out.
    """
    base = ids.where(taxid_valid(F.col(column))).select(F.col(column).alias("original"))
    places = F.transform(F.sequence(F.lit(0), F.lit(98)), lambda i: F.struct((i / 9).cast("int").alias("p"), (i % 9 + 1).cast("int").alias("k")))
    rows = base.select("original", F.inline(places))
    digit = (F.substring("original", F.col("p") + 1, F.lit(1)).cast("int") + F.col("k")) % 10
    return rows.select("original", F.concat(F.substring("original", F.lit(1), F.col("p")), digit.cast("string"), F.substring("original", F.col("p") + 2, F.lit(11))).alias("mutado"))


def undetected(ids: DataFrame, column: str = "cuil_norm", rule: Column | None = None) -> DataFrame:
    """One row: `base, mutaciones, no_detectadas` under the rule (the check digit by default)."""
    m = mutations(ids, column)
    ok = taxid_valid(F.col("mutado")) if rule is None else rule
    return m.agg((F.count(F.lit(1)) / 99).cast("bigint").alias("base"), F.count(F.lit(1)).alias("mutaciones"), F.count_if(ok).alias("no_detectadas"))
