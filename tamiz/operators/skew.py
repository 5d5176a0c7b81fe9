"""Lookups that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.session import cut

#: A key is hot above this many rows and this share of the rows; so hot keys number at most HOT_SHARE.
HOT_ROWS, HOT_SHARE = 200_000, 1000


def skewed_lookup(big: DataFrame, table: DataFrame, key: str, how: str = "inner", weight: str | None = None, rows: int | None = None) -> DataFrame:
    """`big JOIN table USING (key)` where `table` has each key once.

    Keys with more than max(HOT_ROWS, rows / HOT_SHARE) rows are at most HOT_SHARE in number, so their entries
    of `table` are broadcast and their rows stay where they are; all other keys shuffle, none of them heavy.
    `weight` names a column of `table` that already holds the rows per key; `rows` is a known upper bound of the rows
    of `big`, which spares counting them. A null key matches nothing; a left lookup keeps such rows where
    they are instead of shuffling them all into one partition.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    if how == "left" and big.schema[key].nullable:
        known = _lookup(big.where(F.col(key).isNotNull()), table, key, how, weight, rows)
        return known.unionByName(big.where(F.col(key).isNull()), allowMissingColumns=True)
    return _lookup(big, table, key, how, weight, rows)


def _lookup(big: DataFrame, table: DataFrame, key: str, how: str, weight: str | None, rows: int | None) -> DataFrame:
    if rows is not None and rows <= HOT_ROWS:
        return big.join(table, key, how)
    if weight is None:
        sizes = big.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        total = big.count()
        if total <= HOT_ROWS:
            return big.join(table, key, how)
        hot = cut(sizes.where(F.col(key).isNotNull() & (F.col("__n") > max(HOT_ROWS, total // HOT_SHARE))).select(key))
    else:
        total = table.agg(F.sum(weight)).first()[0] or 0
        if total <= HOT_ROWS:
            return big.join(table, key, how)
        hot = cut(table.where(F.col(weight) > max(HOT_ROWS, total // HOT_SHARE)).select(key))
    if hot.isEmpty():
        return big.join(table, key, how)
    mark = F.broadcast(hot.withColumn("__hot", F.lit(True)))
    marked = big.join(mark, key, "left")
    few = table.join(F.broadcast(hot), key, "left_semi")
    heavy = marked.where("__hot").drop("__hot").join(F.broadcast(few), key, how)
    light = marked.where("__hot is null").drop("__hot").join(table, key, how)
    return heavy.unionByName(light)
