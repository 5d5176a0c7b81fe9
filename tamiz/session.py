"""Session settings and the few cluster-wide helpers every operator shares."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.errors import PySparkRuntimeError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "tamiz", **conf: str) -> SparkSession:
    """A session with this package's settings. The master is whoever's who launched us: spark-submit, spark-defaults or
    `master`; only a plain Python process that names none gets local[*]."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }
    b = SparkSession.builder.appName(app).config(map=base | conf)
    if master is not None:
        b = b.master(master)
    try:
        spark = b.getOrCreate()
    except PySparkRuntimeError as e:
        if master is not None or e.getCondition() != "MASTER_URL_NOT_SET":
            raise
        spark = b.master("local[*]").getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context, wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_tamiz_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="tamiz-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "tamiz.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(folder / "tamiz.zip"))
    sc._tamiz_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir of the session. Only on a single machine may it be unset, then a folder of our own is made;
    on a cluster a folder of one machine would lose data, so RuntimeError is raised."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        named = tempfile.mkdtemp(prefix="tamiz-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(f"{named.rstrip('/')}/{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut the lineage; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after measuring that the side has at most `max_rows` rows and `max_bytes` bytes as text;
    else leave it to a shuffle join. The side is materialised first, so it is computed once for both uses."""
    side = cut(df)
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(1)) for c in side.columns), F.lit(8))
    n, total = side.agg(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    return F.broadcast(side) if n <= max_rows and (total or 0) <= max_bytes else side


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A plain projection may be inlined into every later use of its columns, which for deep
    expressions grows without bound. A generator over a one-element array is no such candidate,
    stays inside whole-stage code generation and neither shuffles nor copies data.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
