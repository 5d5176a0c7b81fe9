"""Positions in a total order without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.session import cut


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add `name`: 1, 2, ... in `order`, which must be total.

    Rows are range-partitioned and sorted where they lie; each partition then starts after the sizes of those before it.
    Only one size per partition reaches the driver. The sorted rows are written once, so the ranges can't shift between uses.
    """
    p, i = "__pos_part", "__pos_row"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut(ranged.withColumn(p, F.spark_partition_id()).withColumn(i, F.monotonically_increasing_id()))
    offsets: list[Column] = []
    at = 0
    for part, n in sorted((r[0], r[1]) for r in ranged.groupBy(p).count().collect()):
        offsets += [F.lit(part), F.lit(at)]
        at += n
    base = F.element_at(F.create_map(*offsets), F.col(p)) if offsets else F.lit(0)
    inside = F.col(i).bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn(name, (base + inside + 1).cast("bigint")).drop(p, i)
