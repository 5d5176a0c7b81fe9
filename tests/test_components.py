"""Components and skewed lookups."""

import random

import pytest
from pyspark.sql import functions as F

from tamiz.operators import components as C
from tamiz.operators import skew
from tamiz.operators.order import with_position


def union_find(edges):
    p = {}

    def find(x):
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            p[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in p}


def test_star_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(40), rnd.randrange(40)) for _ in range(25)] + [(100 + i, 101 + i) for i in range(30)] + [(None, 1), (3, 3)]
    got = {r["id"]: r["label"] for r in C.star_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == union_find(edges)
    assert C.star_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("weight", [None, "w"])
def test_skewed_lookup(spark, monkeypatch, weight):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    monkeypatch.setattr(skew, "HOT_SHARE", 10)
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 5}") for i in range(60)] + [(99, None)], "i int, k string")
    table = big.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("w"), F.max("i").alias("m"))
    for how in ("inner", "left"):
        want = sorted(map(str, big.join(table, "k", how).select("i", "k", "m").collect()))
        assert sorted(map(str, skew.skewed_lookup(big, table, "k", how, weight=weight).select("i", "k", "m").collect())) == want


def test_null_keys_stay(spark):
    """Rows with a null key keep their partitions in a left lookup, however many there are."""
    big = spark.range(0, 400, 1, 8).selectExpr("id i", "if(id % 4 = 0, cast(id % 20 as string), null) k")
    table = spark.createDataFrame([("0", 1), ("4", 2)], "k string, m int")
    out = skew.skewed_lookup(big, table, "k", "left")
    assert out.count() == 400 and out.where("k is null and m is null").count() == 300 and out.where("m = 2").count() == 20
    assert out.where("k is null").select(F.spark_partition_id()).distinct().count() >= 8


def test_positions(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("x"))
    got = with_position(df, [F.col("x").desc()], "pos").collect()
    assert sorted((r["pos"], r["x"]) for r in got) == [(i + 1, 499 - i) for i in range(500)]
    assert with_position(df.limit(0), [F.col("x")], "pos").count() == 0


def test_checkpoint_folder():
    """A cluster without a shared folder is refused; a single machine gets its own."""
    from types import SimpleNamespace

    from tamiz.session import ensure_checkpoint_dir

    set_to = []
    fake = lambda master, named: SimpleNamespace(
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=set_to.append), conf=SimpleNamespace(get=lambda k, d=None: named)
    )
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(fake(master, None))
        ensure_checkpoint_dir(fake(master, "hdfs://shared/x/"))
    assert all(x.startswith("hdfs://shared/x/") for x in set_to) and len(set_to) == 3
    ensure_checkpoint_dir(fake("local[4]", None))
    assert len(set_to) == 4
