"""Duplicates by shared keys: components, winner, type adoption, marking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import is_blank, text_or_empty
from tamiz.operators.components import key_edges, star_components
from tamiz.operators.skew import skewed_lookup
from tamiz.plans.config import CANONICAL
from tamiz.session import cut

# How specific a phone type is.
PRECEDENCE = {"celular": 3, "fijo": 2, "ambiguo": 1, "invalido": 0}
KEYS = ["cuil_norm", "telefono_match"]


def completeness(columns: tuple[str, ...] = CANONICAL) -> Column:
    """How many of the columns are not blank."""
    return sum((F.when(is_blank(F.col(c)), 0).otherwise(1) for c in columns), F.lit(0))


def duplicate_components(rows: DataFrame) -> DataFrame:
    """`id_fila, comp` of rows that share a non-empty key with another, directly or through others."""
    edges = key_edges(rows.select("id_fila", *KEYS), "id_fila", KEYS)
    return cut(star_components(edges).select(F.col("id").alias("id_fila"), F.col("label").alias("comp")))


def winners(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """`comp, ganador, w_cuil, w_match, n`: latest raw load date, then most complete, then smallest id.

    One aggregate with partial combination: a component of any size costs one row per task.
    """
    full = F.col("completos") if "completos" in rows.columns else completeness()
    best = F.struct(text_or_empty(F.col("fecha_carga")).alias("f"), full.alias("c"), (-F.col("id_fila")).alias("i"), F.col("cuil_norm").alias("k"), F.col("telefono_match").alias("m"))
    g = comps.join(rows.select("id_fila", best.alias("b")), "id_fila").groupBy("comp").agg(F.max("b").alias("b"), F.count(F.lit(1)).alias("n"))
    return g.select("comp", (-F.col("b.i")).alias("ganador"), F.col("b.k").alias("w_cuil"), F.col("b.m").alias("w_match"), "n")


def mark_duplicates(rows: DataFrame, comps: DataFrame | None = None) -> DataFrame:
    """Add `es_duplicado, duplicado_de, motivo_duplicado`; winners adopt the most specific type of their line.

    `rows` needs a unique `id_fila`, the six lead columns, both keys and `telefono_tipo`. Blank keys link nothing, rows
    without a partner stay as they are, no row is dropped, and only `telefono_tipo` of a winner changes. `duplicado_de`
    is null for rows that are no duplicate. An empty table gives an empty table.
    """
    # What the search needs of a row is written once; the keys' expressions aren't evaluated again for each of its steps.
    thin = cut(rows.select("id_fila", *KEYS, "telefono_tipo", text_or_empty(F.col("fecha_carga")).alias("fecha_carga"), completeness().alias("completos")))
    comps = duplicate_components(thin) if comps is None else comps
    won = cut(winners(thin, comps))
    rank = F.create_map(*[F.lit(x) for kv in PRECEDENCE.items() for x in kv])
    lines = comps.join(thin.select("id_fila", F.col("telefono_match").alias("w_match"), F.coalesce(F.try_element_at(rank, F.col("telefono_tipo")), F.lit(0)).alias("r")), "id_fila")
    lines = lines.where("w_match <> ''").groupBy("comp", "w_match").agg(F.max("r").alias("best"))
    won = won.join(lines, ["comp", "w_match"], "left")
    member = skewed_lookup(comps, won, "comp", weight="n").select("id_fila", "ganador", "w_cuil", "w_match", "best")
    j = rows.join(member, "id_fila", "left")
    loser = F.coalesce(F.col("id_fila") != F.col("ganador"), F.lit(False))
    same = lambda a, b: F.coalesce((F.col(b) != "") & (F.col(a) == F.col(b)), F.lit(False))
    why = F.array_join(F.array_compact(F.array(F.when(same("cuil_norm", "w_cuil"), "cuil"), F.when(same("telefono_match", "w_match"), "telefono"))), "+")
    names = F.create_map(*[F.lit(x) for k, v in PRECEDENCE.items() for x in (v, k)])
    own = F.coalesce(F.try_element_at(rank, F.col("telefono_tipo")), F.lit(0))
    adopted = F.when((F.col("id_fila") == F.col("ganador")) & (F.col("best") > own), F.element_at(names, F.col("best"))).otherwise(F.col("telefono_tipo"))
    return j.select(
        *[c for c in rows.columns if c != "telefono_tipo"], adopted.alias("telefono_tipo"), loser.alias("es_duplicado"),
        F.when(loser, F.col("ganador")).alias("duplicado_de"),
        F.when(loser, F.when(why == "", "transitivo").otherwise(why)).otherwise("").alias("motivo_duplicado"),
    )


def extra_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`clave, sobrantes`: rows beyond the first of each key, with and without the trap of blank keys."""
    def one(name: str) -> DataFrame:
        n = rows.groupBy(F.col(name).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        kept = F.sum(F.when(~is_blank(F.col("k")), F.col("n") - 1).otherwise(0))
        return n.agg(kept.cast("bigint").alias("sobrantes"), F.sum(F.col("n") - 1).cast("bigint").alias("con_vacios")).select(F.lit(name).alias("clave"), "sobrantes", "con_vacios")

    out = one(keys[0])
    for k in keys[1:]:
        out = out.unionByName(one(k))
    return out
