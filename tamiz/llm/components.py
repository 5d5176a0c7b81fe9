"""Pairwise matches consolidated into groups: peel, compress chains, solve the core, put back.

Vertices of degree one are stripped, chains of degree-two vertices are compressed by list
ranking, both in turn until neither is left; what remains is solved by alternating stars and
the labels travel back to the removed vertices in reverse order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.operators.components import key_edges, star_components, tidy_edges
from tamiz.operators.skew import skewed_lookup
from tamiz.session import cut


#: A round that takes no more than this share of the vertices hands the rest to the core solver.
CORE_SHARE = 0.1


def _around(e: DataFrame) -> DataFrame:
    """`x, deg, a, b`: degree, smallest and largest neighbour; combined before the shuffle, so hubs cost nothing extra."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return cut(both.groupBy(F.col("u").alias("x")).agg(F.count(F.lit(1)).alias("deg"), F.min("v").alias("a"), F.max("v").alias("b")))


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v"))


def _strip(e: DataFrame, around: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove leaves: (edges left, `x, parent`). Of two leaves that only have each other, the smaller stays."""
    leaves = around.where("deg = 1").select("x", F.col("a").alias("parent"))
    mutual = leaves.select(F.col("parent").alias("x"), F.col("x").alias("parent"))
    gone = cut(leaves.join(mutual.withColumn("__m", F.lit(True)), ["x", "parent"], "left").where("__m is null or x > parent").select("x", "parent"))
    # A leaf has one edge, so the edges to drop are known as pairs and no hub is joined by its id.
    return cut(e.join(_pairs(gone, "x", "parent"), ["u", "v"], "left_anti")), gone


def _compress(e: DataFrame, around: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Replace chains of degree-two vertices by one edge: (edges left, `x, parent`, vertices removed).

    Every such vertex has two ports; a port points to the port on the far side of its neighbour, or has arrived if
    the neighbour ends the chain. Pointer doubling takes as many rounds as the length has binary digits. Ports that never
    arrive lie on closed rings and stay for the core. In the doubling each port is pointed to at most once; in the first step
    a hub may be the neighbour of any number of chain ends, so that lookup is the skew-safe one.
    """
    two = around.where("deg = 2").select("x", "a", "b")
    ports = two.select("x", F.inline(F.array(F.struct(F.col("a").alias("d"), F.col("a").alias("to")), F.struct(F.col("b").alias("d"), F.col("b").alias("to")))))
    inner = two.select(F.col("x").alias("to"), "a", "b")
    # A port is (x, d): from x towards neighbour d. Beyond a chain vertex it goes on towards that vertex's other neighbour.
    ports = skewed_lookup(ports, inner, "to", "left").select(
        "x", "d", "to", F.when(F.col("a").isNotNull(), F.when(F.col("a") == F.col("x"), F.col("b")).otherwise(F.col("a"))).alias("on")
    )
    ports = cut(ports)
    open_now = ports.where("on is not null").count()
    while open_now:
        far = ports.select(F.col("x").alias("to"), F.col("d").alias("on"), F.col("to").alias("to2"), F.col("on").alias("on2"))
        done = ports.where("on is null")
        moved = ports.where("on is not null").join(far, ["to", "on"]).select("x", "d", F.col("to2").alias("to"), F.col("on2").alias("on"))
        ports = cut(done.unionByName(moved))
        left = ports.where("on is not null").count()
        if left == open_now:
            break
        open_now = left
    ends = ports.where("on is null").groupBy("x").agg(F.min("to").alias("p"), F.max("to").alias("q"), F.count(F.lit(1)).alias("k")).where("k = 2")
    ends = cut(ends.join(two, "x").select("x", "p", "q", "a", "b"))
    n = ends.count()
    drop = _pairs(ends, "x", "a").unionByName(_pairs(ends, "x", "b"))
    short = ends.where("p <> q").select(F.col("p").alias("u"), F.col("q").alias("v")).distinct()
    rest = e.join(drop, ["u", "v"], "left_anti").unionByName(short).distinct()
    return cut(rest), ends.select("x", F.col("p").alias("parent")), n


def consolidate(edges: DataFrame) -> DataFrame:
    """`id, grupo` of every vertex of `edges(u, v)` that has another; `grupo` is the smallest id it is linked with.

    Nulls, loops and repeated edges don't matter; an empty table gives no rows. Ids are BIGINT.
    """
    e = cut(tidy_edges(edges))
    removed: list[DataFrame] = []
    while True:
        around = _around(e)
        vertices, leaves, two = around.agg(F.count(F.lit(1)), F.count_if(F.expr("deg = 1")), F.count_if(F.expr("deg = 2"))).first()
        taken = 0
        if leaves:
            e, gone = _strip(e, around)
            removed.append(gone)
            taken += gone.count()
            around = _around(e)
            two = around.where("deg = 2").count()
        if two:
            e, gone, n = _compress(e, around)
            removed.append(gone)
            taken += n
        # What is left once a round takes little is the core: closed rings and vertices of higher degree.
        if taken <= vertices * CORE_SHARE:
            break
    labels = star_components(e).select(F.col("id").alias("x"), "label")
    # What was stripped last comes back first. A parent that was removed later already has its label by then;
    # one that never lost an edge to another vertex is the root of its own tree.
    for gone in reversed(removed):
        looked = skewed_lookup(gone, labels.select(F.col("x").alias("parent"), "label"), "parent", "left")
        looked = cut(looked.select("x", "parent", F.coalesce("label", "parent").alias("label"), F.col("label").isNull().alias("__root")))
        roots = looked.where("__root").select(F.col("parent").alias("x"), "label").distinct()
        labels = cut(labels.unionByName(looked.select("x", "label")).unionByName(roots))
    smallest = labels.groupBy("label").agg(F.min("x").alias("grupo"), F.count(F.lit(1)).alias("__w"))
    return skewed_lookup(labels, smallest, "label", weight="__w").select(F.col("x").alias("id"), "grupo")


def declared_edges(rows: DataFrame, row_id: str = "id_fila", other: str = "duplicado_de") -> DataFrame:
    """Edges from each row to the row it is declared a duplicate of; a declared row that doesn't exist is no link."""
    e = rows.where(F.col(other).isNotNull()).select(F.col(row_id).cast("bigint").alias("u"), F.col(other).cast("bigint").alias("v"))
    ids = rows.select(F.col(row_id).cast("bigint").alias("v")).distinct()
    return skewed_lookup(e, ids, "v").select("u", "v")


def found_groups(spark, sf_dir: str) -> DataFrame:
    """Problem 5: rows of salida_adv1 linked by tax id, phone key or declaration, with their group."""
    t = spark.read.parquet(f"{sf_dir}/salida_adv1.parquet").select("id_fila", "duplicado_de", "cuil_norm", "telefono_match")
    edges = key_edges(t, "id_fila", ["cuil_norm", "telefono_match"]).unionByName(declared_edges(t))
    return consolidate(edges).select(F.col("id").alias("id_fila"), "grupo")
