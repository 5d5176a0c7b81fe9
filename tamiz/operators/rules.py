"""Coverage, person type, opt-out, additive score with its explanation, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.phone import is_filler_phone, phone_norm
from tamiz.functions.taxid import person_type, taxid_digits
from tamiz.functions.text import fold, is_blank, locality_core, py_fold, text_or_empty, trim_ws
from tamiz.plans.config import Filler, OptOut, Scoring, Segment
from tamiz.session import small_side

DISCARD = " → descarte"


def with_coverage(df: DataFrame, zone: tuple[str, ...]) -> DataFrame:
    """Add `sin_localidad, en_zona, marcado, motivo_descarte`; reasons in fixed order, joined by `; `."""
    blank = is_blank(F.col("localidad"))
    inside = locality_core(F.col("localidad")).isin(*[py_fold(z) for z in zone]) if zone else F.lit(False)
    df = df.withColumns({"sin_localidad": blank, "en_zona": ~blank & inside})
    reasons = F.array_compact(
        F.array(
            F.when(F.col("telefono_tipo") == "invalido", "sin teléfono utilizable"),
            F.when(is_blank(F.col("nombre")), "sin nombre"),
            F.when(F.col("sin_localidad"), "sin localidad").when(~F.col("en_zona"), "fuera de zona de cobertura"),
        )
    )
    return df.withColumns({"marcado": F.size(reasons) > 0, "motivo_descarte": F.array_join(reasons, "; ")})


def with_segment(df: DataFrame, segment: Segment) -> DataFrame:
    """Add `tipo_persona` and the discard by segment only where configured; otherwise the input itself."""
    if not segment.active:
        return df
    kind = person_type(F.col("cuil_norm"))
    if segment.label:
        df = df.withColumn("tipo_persona", kind)
    if segment.discard:
        label = {"fisica": "persona física", "juridica": "persona jurídica"}[segment.discard]
        hit = kind == segment.discard
        df = df.withColumns({"descarte_segmento": hit, "motivo_segmento": F.when(hit, f"{label} (segmento no buscado)").otherwise("")})
    return df


def optout_sets(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(`telefono_norm` set, `cuil_norm` set, one row of counts) of an opt-out list with `telefono` and/or `cuil`."""
    tel = F.col("telefono") if "telefono" in rows.columns else F.lit("")
    cuil = F.col("cuil") if "cuil" in rows.columns else F.lit("")
    base = rows.select(phone_norm(tel).alias("t"), taxid_digits(cuil).alias("c"), is_blank(tel).alias("tb"), is_blank(cuil).alias("cb"))
    phones = base.where("t <> ''").select(F.col("t").alias("telefono_norm")).distinct()
    ids = base.where("length(c) = 11").select(F.col("c").alias("cuil_norm")).distinct()
    counts = base.agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(F.expr("t = '' and not tb")).alias("telefonos_ilegibles"), F.count_if(F.expr("length(c) <> 11 and not cb")).alias("cuils_ilegibles")
    )
    return phones, ids, counts


def with_optout(df: DataFrame, phones: DataFrame, ids: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Add `optout_via` (telefono, cuil, ambos or null). Two equi existence joins on canonical keys, never an OR join;
    each set is broadcast only if counted small. An empty canonical number never matches."""
    p = small_side(phones.select(F.col("telefono_norm").alias("__t")).distinct().withColumn("__pt", F.lit(True)), max_rows)
    c = small_side(ids.select(F.col("cuil_norm").alias("__c")).distinct().withColumn("__pc", F.lit(True)), max_rows)
    j = df.join(p, (F.col("telefono_norm") == F.col("__t")) & (F.col("telefono_norm") != ""), "left").join(c, (F.col("cuil_norm") == F.col("__c")) & (F.length("cuil_norm") == 11), "left")
    via = F.when(F.col("__pt") & F.col("__pc"), "ambos").when(F.col("__pt"), "telefono").when(F.col("__pc"), "cuil")
    return j.withColumn("optout_via", via).drop("__t", "__c", "__pt", "__pc")


def _points(table: dict[str, int], key: Column) -> Column:
    if not table:
        return F.lit(0)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key), F.lit(0))


def with_score(df: DataFrame, scoring: Scoring, filler: Filler, optout: OptOut | None = None) -> DataFrame:
    """Add `detalle, puntaje, prioridad, motivo`.

    `detalle` is the typed explanation, an array of (texto, puntos, descarte); the score is its sum and `motivo` its
    rendering, so the numbers in the text always add up to the score. Any discard, or too few points, gives `descartado`.
    """
    def part(when: Column | None, text: Column | str, points: Column | int = 0, out: Column | bool = False) -> Column:
        lit = lambda x, t: (x if isinstance(x, Column) else F.lit(x)).cast(t)
        s = F.struct(lit(text, "string").alias("texto"), lit(points, "int").alias("puntos"), lit(out, "boolean").alias("descarte"))
        return s if when is None else F.when(when, s)

    kind, origin = trim_ws(text_or_empty(F.col("telefono_tipo"))), trim_ws(text_or_empty(F.col("origen")))
    usable = kind.isin(*scoring.phone)
    fresh = F.col("frescura")
    parts = [
        part(None, F.when(usable, kind).otherwise("sin teléfono"), _points(scoring.phone, kind), ~usable),
        part(is_filler_phone(F.col("telefono_norm"), list(filler.sequences), filler.tail), "teléfono de relleno", 0, True),
        part(None, F.when(F.col("cuil_valido"), "cuil válido").otherwise("cuil inválido"), F.when(F.col("cuil_valido"), scoring.taxid_valid).otherwise(scoring.taxid_invalid)),
        part(
            None, F.when(F.col("sin_localidad"), "sin localidad").when(F.col("en_zona"), "en zona").otherwise("fuera de zona"),
            F.when(F.col("en_zona"), scoring.in_zone).otherwise(0), ~F.col("sin_localidad") & ~F.col("en_zona"),
        ),
        part(None, F.concat(F.lit("frescura "), fresh), _points(scoring.freshness, fresh)),
        part(None, F.when(origin == "", "origen desconocido").otherwise(origin), _points(scoring.origin, origin)),
        part(F.col("es_duplicado"), "duplicado", 0, True),
    ]
    if "descarte_segmento" in df.columns:
        parts.append(part(F.col("descarte_segmento"), F.col("motivo_segmento"), 0, True))
    if optout is not None and "optout_via" in df.columns:
        parts.append(part(F.col("optout_via").isNotNull(), optout.reason, 0, True))
    if filler.names:
        parts.append(part(fold(F.col("nombre")).isin(*[py_fold(n) for n in filler.names]), "nombre de relleno"))
    df = df.withColumn("detalle", F.array_compact(F.array(*parts)))
    df = df.withColumn("puntaje", F.aggregate("detalle", F.lit(0), lambda a, x: a + x["puntos"]))
    out = F.exists("detalle", lambda x: x["descarte"])
    text = F.transform("detalle", lambda x: F.concat(x["texto"], F.format_string(" %+d", x["puntos"]), F.when(x["descarte"], DISCARD).otherwise("")))
    return df.withColumns(
        {
            "prioridad": F.when(out, "descartado").when(F.col("puntaje") >= scoring.high, "alta").when(F.col("puntaje") >= scoring.medium, "media").otherwise("descartado"),
            "motivo": F.array_join(text, "; "),
        }
    )


def rank_order() -> list[Column]:
    """Priority block, score down, age up with unknown last, file position: a total order."""
    block = F.when(F.col("prioridad") == "alta", 0).when(F.col("prioridad") == "media", 1).otherwise(2)
    return [block.asc(), F.col("puntaje").desc(), F.col("dias_antiguedad").asc_nulls_last(), F.col("id_fila").asc()]
