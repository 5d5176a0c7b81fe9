"""One surviving record per group of duplicates, built field by field; and what the sources are worth.

`survivors` picks, for every field, the row that supplies it by a stated order. `value_truth` is the
latent two-sided quality model: it learns each source's sensitivity and specificity by
expectation-maximisation and keeps every value judged true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.functions.dates import load_date
from tamiz.functions.taxid import taxid_valid
from tamiz.functions.text import fold, is_blank
from tamiz.llm.components import consolidate, declared_edges
from tamiz.operators.skew import skewed_lookup
from tamiz.session import cut

FIELDS = ("nombre", "cuil", "telefono", "localidad", "origen", "fecha_carga")


def usable(field: str) -> Column:
    """Whether the row's value of a lead field may survive."""
    if field == "telefono":
        return F.coalesce(F.col("telefono_norm") != "", F.lit(False))
    if field == "cuil":
        return taxid_valid(F.col("cuil"))
    if field == "fecha_carga":
        return load_date(F.col("fecha_carga")).isNotNull()
    return ~is_blank(F.col(field))


def duplicate_groups(rows: DataFrame) -> DataFrame:
    """`id_fila, grupo` of rows joined by `duplicado_de`, directly or through others."""
    return consolidate(declared_edges(rows)).select(F.col("id").alias("id_fila"), "grupo")


def survivors(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """`grupo, campo, id_fila`: the row that supplies each field of a group's surviving record.

    Among rows with a usable value: latest load date (none is oldest), most non-blank fields, smallest id.
    A field nobody can supply has no row. Ids are unique on both sides, so the join is even; the choice is one
    aggregate over the group, combined before the shuffle, so a group of a third of all rows is no burden.
    """
    full = sum((F.when(is_blank(F.col(c)), 0).otherwise(1) for c in FIELDS), F.lit(0))
    rank = F.struct(F.coalesce(load_date(F.col("fecha_carga")), F.lit("0001-01-01").cast("date")).alias("d"), full.alias("n"), (-F.col("id_fila")).alias("i"))
    marked = rows.select("id_fila", rank.alias("__rank"), *[usable(c).alias(f"__{c}") for c in FIELDS])
    best = marked.join(groups, "id_fila").groupBy("grupo").agg(*[F.max(F.when(F.col(f"__{c}"), F.col("__rank"))).alias(c) for c in FIELDS])
    long = best.select("grupo", F.inline(F.array(*[F.struct(F.lit(c).alias("campo"), (-F.col(c)["i"]).alias("id_fila")) for c in FIELDS])))
    return long.where("id_fila is not null")


def claim_patterns(claims: DataFrame) -> DataFrame:
    """`objeto, campo, valor, patron(cubren, dicen)`: for each claimed value the sources that cover its object's field and
    those that claim it. Repeated claims count once, nulls in any column are left out.

    Arrays are no longer than the number of sources, and are combined before the shuffle.
    """
    c = claims.select("objeto", "campo", "valor", "fuente").where(F.expr("objeto is not null and campo is not null and valor is not null and fuente is not null"))
    said = cut(c.groupBy("objeto", "campo", "valor").agg(F.sort_array(F.collect_set("fuente")).alias("dicen")))
    cover = said.select("objeto", "campo", F.explode("dicen").alias("fuente")).groupBy("objeto", "campo").agg(F.sort_array(F.collect_set("fuente")).alias("cubren"))
    return said.join(cover, ["objeto", "campo"]).select("objeto", "campo", "valor", F.struct("cubren", "dicen").alias("patron"))


def source_quality(patterns: DataFrame, tolerance: float = 1e-3, max_rounds: int = 300, max_sources: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(`fuente, sens, spec, prior`, `patron, probabilidad`) of the latent two-sided model for `patterns(patron, n)`.

    Values with the same covering and claiming sources are equally likely, so expectation-maximisation runs on the distinct
    patterns and their counts, which are sufficient. It goes on until no rate moves by more than `tolerance` and raises
    RuntimeError if that takes more than `max_rounds` rounds; the lineage is cut every round.
    """
    numbered = cut(patterns.withColumn("pid", F.monotonically_increasing_id()))
    m = cut(
        numbered.select("pid", "n", (F.col("n") / F.size("patron.cubren")).alias("once"), "patron.dicen", F.explode("patron.cubren").alias("fuente"))
        .select("pid", "n", "once", "fuente", F.array_contains("dicen", F.col("fuente")).cast("int").alias("says"))
    )
    rates = cut(m.select("fuente").distinct().select("fuente", F.lit(0.8).alias("sens"), F.lit(0.9).alias("spec"), F.lit(0.5).alias("prior")))
    few = F.broadcast if rates.count() <= max_sources else (lambda x: x)
    clip = lambda x: F.least(F.greatest(x, F.lit(0.01)), F.lit(0.99))

    def judged() -> DataFrame:
        says = F.when(F.col("says") == 1, F.log(F.col("sens") / (1 - F.col("spec")))).otherwise(F.log((1 - F.col("sens")) / F.col("spec")))
        odds = F.sum(says).over(Window.partitionBy("pid")) + F.log(F.col("prior") / (1 - F.col("prior")))
        return m.join(few(rates), "fuente").withColumn("p", 1 / (1 + F.exp(-odds)))

    # One claim of each kind as a prior keeps the rates off 0 and 1.
    sens = clip((F.col("ct") + 0.8) / (F.col("t") + 1))
    spec = clip((F.col("k") - F.col("t") - F.col("ck") + F.col("ct") + 0.9) / (F.col("k") - F.col("t") + 1))
    for _ in range(max_rounds):
        np, says = F.col("n") * F.col("p"), F.col("says")
        s = judged().groupBy("fuente").agg(
            F.sum(np).alias("t"), F.sum("n").alias("k"), F.sum(np * says).alias("ct"), F.sum(F.col("n") * says).alias("ck"), F.sum(F.col("once") * F.col("p")).alias("true"), F.sum("once").alias("all"),
            *[F.first(c).alias(f"old_{c}") for c in ("sens", "spec", "prior")],
        )
        s = cut(s)
        moved, true, total, old = s.agg(F.max(F.greatest(F.abs(sens - F.col("old_sens")), F.abs(spec - F.col("old_spec")))), F.sum("true"), F.sum("all"), F.max("old_prior")).first()
        if total is None:
            break
        prior = min(max(true / total, 0.01), 0.99)
        rates = s.select("fuente", sens.alias("sens"), spec.alias("spec"), F.lit(prior).alias("prior"))
        if max(moved, abs(prior - old)) <= tolerance:
            break
    else:
        raise RuntimeError(f"the sources' rates did not settle in {max_rounds} rounds")
    p = judged().groupBy("pid").agg(F.max("p").alias("probabilidad"))
    return rates, cut(numbered.join(p, "pid").select("patron", "n", "probabilidad"))


def value_truth(claims: DataFrame, tolerance: float = 1e-3, max_rounds: int = 300) -> DataFrame:
    """`objeto, campo, valor, probabilidad` for `claims(objeto, campo, valor, fuente)`.

    A source covers an object's field if it claims any value of it. A true value is claimed by a covering source
    with the source's sensitivity, a false one with one minus its specificity; both are learnt by
    expectation-maximisation together with the share of true values. Values are judged one by one, so a field may keep
    several. Nulls in any column are left out; repeated claims count once; no claims give no rows.
    """
    values = cut(claim_patterns(claims))
    patterns = values.groupBy("patron").agg(F.count(F.lit(1)).alias("n"))
    _, judged = source_quality(patterns, tolerance, max_rounds)
    return skewed_lookup(values, judged, "patron", weight="n").select("objeto", "campo", "valor", "probabilidad")


def found(spark, sf_dir: str) -> DataFrame:
    """Problem 3: the supplying row of each field of each group of declared duplicates."""
    t = spark.read.parquet(f"{sf_dir}/salida_adv1.parquet")
    return survivors(t, duplicate_groups(t.select("id_fila", "duplicado_de")))


def _cells(rows: DataFrame) -> DataFrame:
    """`id_fila, fuente, campo, valor`: the usable lead fields, folded; lots are the sources."""
    cells = F.array(*[F.struct(F.lit(c).alias("campo"), F.when(usable(c), fold(F.col(c))).alias("valor")) for c in FIELDS])
    return rows.select("id_fila", F.col("archivo_id").alias("fuente"), F.inline(cells)).where("valor is not null")


def _judged(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return value_truth(_cells(rows).join(groups, "id_fila").select(F.col("grupo").alias("objeto"), "campo", "valor", "fuente"))


def truth(spark, sf_dir: str) -> DataFrame:
    """Every value of every lead field in the groups, with its probability of being true."""
    t = spark.read.parquet(f"{sf_dir}/salida_adv1.parquet")
    return _judged(t, duplicate_groups(t.select("id_fila", "duplicado_de"))).withColumn("probabilidad", F.round("probabilidad", 6))


def agreement(spark, sf_dir: str) -> DataFrame:
    """`campo, casos, iguales, disputados, iguales_disputados`: how often the surviving value by the stated order is one that
    the model finds most probable, among all group fields and among those with more than one value."""
    t = spark.read.parquet(f"{sf_dir}/salida_adv1.parquet")
    groups = cut(duplicate_groups(t.select("id_fila", "duplicado_de")))
    judged = cut(_judged(t, groups))
    best = judged.groupBy("objeto", "campo").agg(F.max("probabilidad").alias("top"), F.count(F.lit(1)).alias("k"))
    chosen = survivors(t, groups).join(_cells(t), ["id_fila", "campo"]).select(F.col("grupo").alias("objeto"), "campo", "valor")
    j = chosen.join(judged, ["objeto", "campo", "valor"]).join(best, ["objeto", "campo"])
    same = F.col("probabilidad") > F.col("top") - 1e-9
    return j.groupBy("campo").agg(
        F.count(F.lit(1)).alias("casos"), F.count_if(same).alias("iguales"), F.count_if(F.col("k") > 1).alias("disputados"), F.count_if(same & (F.col("k") > 1)).alias("iguales_disputados")
    )
