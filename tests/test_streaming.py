"""Streams of leads: the narrow steps equal the batch ones; a repeated batch doesn't double rows."""

from tamiz.plans.config import CANONICAL, PlanConfig
from tamiz.plans.pipeline import build
from tamiz.streaming.leads import canonical_stream, recompute_each_batch

SCHEMA = "id_fila long, " + ", ".join(f"{c} string" for c in CANONICAL)
ROWS = [(1, "Ana", "20-12345678-6", "1145551111", "Haedo", "referido", "2026-07-01"), (2, "Eva", "", "sin dato", "", "", "ayer"), (3, "Leo", "20123456786", "", "Merlo", "evento", "")]


def test_canonical_stream(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "in"))
    c = PlanConfig(cutoff="2026-07-28")
    out = canonical_stream(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), c)
    q = out.writeStream.format("memory").queryName("canon").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {r["id_fila"]: r for r in spark.table("canon").collect()}
    want = {r["id_fila"]: r for r in build(spark.createDataFrame(ROWS, SCHEMA), "05", c).collect()}
    for k in ("telefono_norm", "cuil_valido", "en_zona", "frescura", "motivo_descarte"):
        assert {i: r[k] for i, r in got.items()} == {i: r[k] for i, r in want.items()}


def test_recompute(spark, tmp_path):
    seen = []
    run = recompute_each_batch(str(tmp_path / "store"), lambda df, n: seen.append((n, df.count(), df.where("es_duplicado").count())), PlanConfig(cutoff="2026-07-28"))
    one, two = (spark.createDataFrame(x, SCHEMA) for x in (ROWS[:2], ROWS[2:]))
    run(one, 0)
    run(two, 1)
    run(two, 1)
    assert seen == [(0, 2, 0), (1, 3, 1), (1, 3, 1)]
