"""One query per operator over the derived leads, and the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.dates import age_bucket, age_days, age_reasons, load_date, resolve_cutoff
from tamiz.functions.phone import is_filler_phone, match_key, phone_norm, with_phone
from tamiz.functions.taxid import person_type, with_taxid
from tamiz.functions.text import fold, is_blank, locality_core, py_fold, signed
from tamiz.operators import dedup, mutations, report, rules
from tamiz.operators.compare import differences
from tamiz.operators.order import with_position
from tamiz.plans.config import CANONICAL, FILLER_NAMES, FILLER_SEQUENCES, PlanConfig, Segment
from tamiz.plans.derived import CUTOFF, leads, oracle_leads
from tamiz.plans.pipeline import AUDIT, COMMERCIAL, build, coerce
from tamiz.session import cut
from tamiz.sources.sinks import csv_lines

CONFIG = PlanConfig(cutoff=CUTOFF)
SEGMENT = PlanConfig(cutoff=CUTOFF, segment=Segment(True, "juridica"))
EARLIER = "2001-07-01"


def keyed(spark, d) -> DataFrame:
    df = with_taxid(with_phone(leads(spark, d), "telefono"), "cuil")
    return df.withColumn("telefono_match", match_key(F.col("telefono_norm")))


def scored(spark, d) -> DataFrame:
    return build(leads(spark, d), "08", CONFIG)


def optout_rows(spark, d) -> DataFrame:
    """Every 23rd customer asks to be left alone; phones as written by others, ids every 46th."""
    df = leads(spark, d).where("id_fila % 23 = 0")
    return df.select(F.concat(F.lit(" "), F.col("telefono"), F.lit(" ")).alias("telefono"), F.when(F.col("id_fila") % 46 == 0, F.col("cuil")).otherwise("").alias("cuil"))


def dates(spark, d, cutoff=CUTOFF) -> DataFrame:
    raw = F.col("fecha_carga")
    days = age_days(load_date(raw), resolve_cutoff(cutoff)[0])
    return leads(spark, d).select("id_fila", days.alias("dias_antiguedad"), age_bucket(days).alias("frescura"), age_reasons(raw, days).alias("motivo_frescura"))


def components(spark, d) -> DataFrame:
    return dedup.duplicate_components(keyed(spark, d))


def winner(spark, d) -> DataFrame:
    rows = cut(keyed(spark, d))
    return dedup.winners(rows, dedup.duplicate_components(rows)).select("comp", "ganador", "n")


def marking(spark, d) -> DataFrame:
    return dedup.mark_duplicates(keyed(spark, d)).select("id_fila", "telefono_tipo", "es_duplicado", "duplicado_de", "motivo_duplicado")


def coverage(spark, d) -> DataFrame:
    return rules.with_coverage(keyed(spark, d), CONFIG.zone).select("id_fila", "sin_localidad", "en_zona", "marcado", "motivo_descarte")


def optout(spark, d) -> DataFrame:
    phones, ids, _ = rules.optout_sets(optout_rows(spark, d))
    return rules.with_optout(keyed(spark, d), phones, ids).where("optout_via is not null").select("id_fila", "optout_via")


def law(spark, d) -> DataFrame:
    found = F.regexp_extract_all("motivo", F.lit(r"([+-][0-9]+)"), F.lit(1))
    total = F.aggregate(F.transform(found, lambda x: x.cast("int")), F.lit(0), lambda a, x: a + x)
    return scored(spark, d).agg(F.count(F.lit(1)).alias("filas"), F.count_if(total != F.col("puntaje")).alias("desvios"))


def ranking(spark, d) -> DataFrame:
    done = with_position(scored(spark, d), rules.rank_order(), "orden")
    return done.select("orden", *AUDIT)


def segment(spark, d) -> DataFrame:
    return rules.with_segment(keyed(spark, d), SEGMENT.segment).select("id_fila", "tipo_persona", "descarte_segmento", "motivo_segmento")


def optout_values(spark, d) -> DataFrame:
    phones, ids, _ = rules.optout_sets(optout_rows(spark, d))
    return phones.select(F.lit("telefono").alias("clase"), F.col("telefono_norm").alias("valor")).unionByName(ids.select(F.lit("cuil").alias("clase"), F.col("cuil_norm").alias("valor")))


def everything(spark, d) -> DataFrame:
    """Plan 14 with the opt-out list and the segment on."""
    done = build(leads(spark, d), "14", SEGMENT, rules.optout_sets(optout_rows(spark, d))[:2])
    return done.select("id_fila", "tipo_persona", "optout_via", "puntaje", "prioridad", "motivo")


def positions(spark, d) -> DataFrame:
    rows = leads(spark, d).select("id_fila", "nombre", "origen")
    return with_position(rows, [F.col("origen").asc(), F.col("id_fila").desc()], "posicion").select("id_fila", "posicion")


def delivered(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/leads_prueba_sintetico_1.parquet").withColumn("id_fila", F.col("lead_id"))


def records(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/leads_adversario_2.parquet")


def one(*columns):
    return lambda spark, d: scored(spark, d).select("id_fila", *columns)


QUERIES = {
    "n1_phone": lambda s, d: keyed(s, d).select("id_fila", "telefono_norm", "telefono_tipo", "telefono_match"),
    "n2_taxid": lambda s, d: keyed(s, d).select("id_fila", "cuil_norm", "cuil_valido", "cuil_dudoso"),
    "n5_locality": lambda s, d: leads(s, d).select("id_fila", fold(F.col("localidad")).alias("plegada"), locality_core(F.col("localidad")).alias("nucleo")),
    "n8_dates": dates,
    "n12_person": lambda s, d: keyed(s, d).groupBy(person_type(F.col("cuil_norm")).alias("tipo_persona")).agg(F.count(F.lit(1)).alias("filas")),
    "n13_filler_phone": lambda s, d: keyed(s, d).where(is_filler_phone(F.col("telefono_norm"), list(FILLER_SEQUENCES), 7)).select("id_fila"),
    "n14_filler_name": lambda s, d: leads(s, d).where(fold(F.col("nombre")).isin(*map(py_fold, FILLER_NAMES))).select("id_fila"),
    "n15_signed": lambda s, d: leads(s, d).select("id_fila", signed((F.col("id_fila") % 41 - 20).cast("int")).alias("firmado")),
    "n16_completeness": lambda s, d: leads(s, d).select("id_fila", dedup.completeness().alias("completos")),
    "flt_p3_coverage": coverage,
    "flt_p5_segment": segment,
    "j1_optout": optout,
    "j2_optout_counts": lambda s, d: rules.optout_sets(optout_rows(s, d))[2],
    "a1_components": components,
    "a2_winner": winner,
    "a4_marking": marking,
    "g1_score": one("puntaje"),
    "g2_motive": one("motivo"),
    "g3_law": law,
    "g4_priority": one("prioridad"),
    "o1_rank": ranking,
    "r1_counts": lambda s, d: report.metrics(scored(s, d)).select("total", "alta", "media", "descartado"),
    "r2_reasons": lambda s, d: report.metrics(scored(s, d)).select(*report.TAGS, "puntaje_bajo"),
    "r5_origin_freq": lambda s, d: report.origin_frequencies(leads(s, d)),
    "r7_extra_rows": lambda s, d: dedup.extra_rows(keyed(s, d), ["cuil_norm", "telefono_match"]),
    "r9_mutations": lambda s, d: mutations.undetected(keyed(s, d)),
    "r3_derived": lambda s, d: report.derived_row(report.metrics(scored(s, d))),
    "k2_audit_lines": lambda s, d: csv_lines(scored(s, d), list(AUDIT)),
    "g4_everything": everything,
    "j2_optout_values": optout_values,
    "j7_differences": lambda s, d: differences(dates(s, d, EARLIER), dates(s, d)),
    "n3_match_key": lambda s, d: delivered(s, d).select("id_fila", match_key(phone_norm(F.col("telefono"))).alias("telefono_match")),
    "n4_position": positions,
    "n7_name_fold": lambda s, d: delivered(s, d).select("id_fila", fold(F.col("nombre")).alias("plegado")),
    "s14_coerce": lambda s, d: coerce(delivered(s, d)),
    "flt_p1_blank": lambda s, d: records(s, d).where(~is_blank(F.col("c0"))).groupBy("archivo_id").agg(F.count(F.lit(1)).alias("registros")),
    "k1_commercial_lines": lambda s, d: csv_lines(scored(s, d), list(COMMERCIAL)),
}

_CANON = f"""
WITH RECURSIVE leads AS ({oracle_leads()}),
c1 AS (SELECT *, trim(telefono) AS tr, regexp_replace(split_part(telefono, '/', 1), '\\s+', '', 'g') AS tc FROM leads),
c2 AS (SELECT *, regexp_replace(tc, '[^0-9]', '', 'g') AS td FROM c1),
c3 AS (SELECT *, CASE WHEN td LIKE '0%' THEN substr(td, 2) ELSE td END AS tl FROM c2),
c4 AS (SELECT *, CASE
    WHEN regexp_matches(tr, '[a-zA-Z]') OR td = '' THEN 'i'
    WHEN starts_with(tc, '+549') THEN CASE WHEN length(td) = 13 THEN 'c+549' || substr(td, 4) ELSE 'i' END
    WHEN starts_with(tc, '+54') THEN CASE WHEN length(td) = 12 THEN 'f+54' || substr(td, 3) ELSE 'i' END
    WHEN td LIKE '549%' AND length(td) = 13 THEN 'c+549' || substr(td, 4)
    WHEN length(tl) BETWEEN 12 AND 14 AND substr(tl, length(tl) - 9, 2) = '15' THEN 'c+549' || substr(tl, 1, length(tl) - 10) || right(tl, 8)
    WHEN length(td) = 11 AND td LIKE '0%' THEN 'f+54' || substr(td, 2)
    WHEN length(td) = 10 AND td LIKE '15%' THEN 'i'
    WHEN length(td) = 10 AND tc NOT LIKE '+%' THEN 'a+54' || td ELSE 'i' END AS tv,
  regexp_replace(cuil, '[^0-9]', '', 'g') AS cuil_norm FROM c3),
c5 AS (SELECT *, substr(tv, 2) AS telefono_norm, CASE substr(tv, 1, 1) WHEN 'c' THEN 'celular' WHEN 'f' THEN 'fijo' WHEN 'a' THEN 'ambiguo' ELSE 'invalido' END AS telefono_tipo,
  length(cuil_norm) = 11 AND substr(cuil_norm, 1, 2) IN ('20', '23', '24', '27', '30', '33', '34') AS shaped FROM c4),
c6 AS (SELECT *, CASE WHEN length(regexp_replace(telefono_norm, '[^0-9]', '', 'g')) >= 10 THEN right(regexp_replace(telefono_norm, '[^0-9]', '', 'g'), 10) ELSE '' END AS telefono_match,
  CASE WHEN shaped THEN ({' + '.join(f"try_cast(substr(cuil_norm, {i + 1}, 1) AS INT) * {w}" for i, w in enumerate((5, 4, 3, 2, 7, 6, 5, 4, 3, 2)))}) % 11 END AS r FROM c5),
canon AS (SELECT *, coalesce(r <> 1 AND try_cast(substr(cuil_norm, 11, 1) AS INT) = CASE WHEN r = 0 THEN 0 ELSE 11 - r END, false) AS cuil_valido, coalesce(r = 1, false) AS cuil_dudoso,
  (CASE WHEN trim(nombre) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(cuil) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(telefono) <> '' THEN 1 ELSE 0 END
   + CASE WHEN trim(localidad) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(origen) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(fecha_carga) <> '' THEN 1 ELSE 0 END) AS completos FROM c6)
"""
_COMPS = """,
edges AS (SELECT min(id_fila) OVER (PARTITION BY cuil_norm) AS u, id_fila AS v FROM canon WHERE cuil_norm <> ''
  UNION ALL SELECT min(id_fila) OVER (PARTITION BY telefono_match), id_fila FROM canon WHERE telefono_match <> ''),
sym AS (SELECT u, v FROM edges WHERE u <> v UNION SELECT v, u FROM edges WHERE u <> v),
reach(id, l) AS (SELECT DISTINCT u, u FROM sym UNION SELECT sym.v, reach.l FROM reach JOIN sym ON sym.u = reach.id),
comps AS (SELECT id AS id_fila, min(l) AS comp FROM reach GROUP BY id),
won AS (SELECT comp, arg_max(id_fila, (fecha_carga, completos, -id_fila)) AS ganador, count(*) AS n FROM comps JOIN canon USING (id_fila) GROUP BY comp),
wk AS (SELECT won.*, canon.cuil_norm AS w_cuil, canon.telefono_match AS w_match FROM won JOIN canon ON canon.id_fila = won.ganador),
prec AS (SELECT * FROM (VALUES ('celular', 3), ('fijo', 2), ('ambiguo', 1), ('invalido', 0)) t(tipo, rango)),
best AS (SELECT comp, telefono_match, max(rango) AS b FROM comps JOIN canon USING (id_fila) JOIN prec ON tipo = telefono_tipo WHERE telefono_match <> '' GROUP BY 1, 2),
marked AS (
  SELECT c.* EXCLUDE (telefono_tipo), CASE WHEN c.id_fila = w.ganador AND b.b > p.rango THEN q.tipo ELSE c.telefono_tipo END AS telefono_tipo,
    coalesce(c.id_fila <> w.ganador, false) AS es_duplicado, CASE WHEN c.id_fila <> w.ganador THEN w.ganador END AS duplicado_de,
    CASE WHEN w.ganador IS NULL OR c.id_fila = w.ganador THEN ''
      WHEN w.w_cuil <> '' AND c.cuil_norm = w.w_cuil AND w.w_match <> '' AND c.telefono_match = w.w_match THEN 'cuil+telefono'
      WHEN w.w_cuil <> '' AND c.cuil_norm = w.w_cuil THEN 'cuil' WHEN w.w_match <> '' AND c.telefono_match = w.w_match THEN 'telefono' ELSE 'transitivo' END AS motivo_duplicado
  FROM canon c LEFT JOIN comps USING (id_fila) LEFT JOIN wk w USING (comp) LEFT JOIN best b ON b.comp = w.comp AND b.telefono_match = w.w_match
  JOIN prec p ON p.tipo = c.telefono_tipo LEFT JOIN prec q ON q.rango = b.b)
"""
_FOLDED = "trim(regexp_replace(lower(strip_accents(localidad)), '\\s+', ' ', 'g'))"
_CORE = f"trim(regexp_replace(regexp_replace({_FOLDED}, '\\s*\\([^)]*\\)\\s*$', ''), ',.*$', ''))"
_ZONE = "('castelar', 'haedo', 'moron', 'hurlingham', 'ituzaingo', 'ramos mejia', 'villa luzuriaga', 'san justo')"
_ISO = (
    "CASE WHEN regexp_full_match(trim(fecha_carga), '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN trim(fecha_carga) "
    "WHEN regexp_full_match(trim(fecha_carga), '[0-9]{2}/[0-9]{2}/[0-9]{4}') THEN substr(trim(fecha_carga), 7, 4) || '-' || substr(trim(fecha_carga), 4, 2) || '-' || substr(trim(fecha_carga), 1, 2) END"
)


def _flags(source: str, name: str, cutoff: str = CUTOFF) -> str:
    return f""",
{name}_a AS (SELECT *, trim(localidad) = '' AS sin_localidad, trim(localidad) <> '' AND {_CORE} IN {_ZONE} AS en_zona, try_cast({_ISO} AS DATE) AS dia FROM {source}),
{name}_b AS (SELECT *, concat_ws('; ', CASE WHEN telefono_tipo = 'invalido' THEN 'sin teléfono utilizable' END, CASE WHEN trim(nombre) = '' THEN 'sin nombre' END,
    CASE WHEN sin_localidad THEN 'sin localidad' WHEN NOT en_zona THEN 'fuera de zona de cobertura' END) AS motivo_descarte,
  CAST(datediff('day', dia, DATE '{cutoff}') AS INT) AS dias_antiguedad FROM {name}_a),
{name} AS (SELECT *, motivo_descarte <> '' AS marcado, '{cutoff}' AS fecha_corte_usada,
  CASE WHEN dias_antiguedad IS NULL OR dias_antiguedad < 0 THEN 'sin dato' WHEN dias_antiguedad <= 15 THEN 'alta' WHEN dias_antiguedad <= 45 THEN 'media' WHEN dias_antiguedad <= 90 THEN 'baja' ELSE 'fria' END AS frescura,
  concat_ws('; ', CASE WHEN trim(fecha_carga) = '' THEN 'fecha vacia' WHEN dia IS NULL THEN 'fecha ilegible'
    WHEN regexp_full_match(trim(fecha_carga), '(0[0-9]|1[0-2])/(0[0-9]|1[0-2])/[0-9]{{4}}') THEN 'fecha ambigua' END,
    CASE WHEN dias_antiguedad < 0 THEN 'fecha futura' END) AS motivo_frescura FROM {name}_b)
"""


_FILLER = f"(length(telefono_match) = 10 AND (telefono_match IN {FILLER_SEQUENCES} OR regexp_full_match(telefono_match, '[0-9]{{3}}(0{{7}}|1{{7}}|2{{7}}|3{{7}}|4{{7}}|5{{7}}|6{{7}}|7{{7}}|8{{7}}|9{{7}})')))"
_NAME_FILLER = f"lower(strip_accents(trim(nombre))) IN {FILLER_NAMES}"
_SCORE = (
    _COMPS
    + _flags("marked", "flagged")
    + f""",
points AS (SELECT *, CASE telefono_tipo WHEN 'celular' THEN 30 WHEN 'fijo' THEN 10 WHEN 'ambiguo' THEN 18 ELSE 0 END AS pt, CASE WHEN cuil_valido THEN 15 ELSE -10 END AS pc,
  CASE WHEN en_zona THEN 20 ELSE 0 END AS pz, CASE frescura WHEN 'alta' THEN 25 WHEN 'media' THEN 15 WHEN 'baja' THEN 5 ELSE 0 END AS pf,
  CASE trim(origen) WHEN 'referido' THEN 15 WHEN 'formulario web' THEN 10 WHEN 'evento' THEN 10 WHEN 'campaña Meta' THEN 5 ELSE 0 END AS po FROM flagged),
summed AS (SELECT *, CAST(pt + pc + pz + pf + po AS INT) AS puntaje, concat_ws('; ',
    CASE WHEN telefono_tipo = 'invalido' THEN 'sin teléfono +0 → descarte' ELSE telefono_tipo || printf(' %+d', pt) END,
    CASE WHEN {_FILLER} THEN 'teléfono de relleno +0 → descarte' END,
    CASE WHEN cuil_valido THEN 'cuil válido +15' ELSE 'cuil inválido -10' END,
    CASE WHEN sin_localidad THEN 'sin localidad +0' WHEN en_zona THEN 'en zona +20' ELSE 'fuera de zona +0 → descarte' END,
    'frescura ' || frescura || printf(' %+d', pf),
    CASE WHEN trim(origen) = '' THEN 'origen desconocido' ELSE trim(origen) END || printf(' %+d', po),
    CASE WHEN es_duplicado THEN 'duplicado +0 → descarte' END, CASE WHEN {_NAME_FILLER} THEN 'nombre de relleno +0' END) AS motivo FROM points),
scored AS (SELECT *, CASE WHEN contains(motivo, '→ descarte') THEN 'descartado' WHEN puntaje >= 70 THEN 'alta' WHEN puntaje >= 40 THEN 'media' ELSE 'descartado' END AS prioridad FROM summed)
"""
)
_RANKED = "row_number() OVER (ORDER BY CASE prioridad WHEN 'alta' THEN 0 WHEN 'media' THEN 1 ELSE 2 END, puntaje DESC, dias_antiguedad ASC NULLS LAST, id_fila)"
_OPTOUT = """,
baja AS (SELECT telefono_norm AS bt, CASE WHEN id_fila % 46 = 0 AND length(cuil_norm) = 11 THEN cuil_norm END AS bc, id_fila, cuil, telefono, telefono_norm, cuil_norm FROM canon WHERE id_fila % 23 = 0),
hit AS (SELECT id_fila, telefono_norm <> '' AND telefono_norm IN (SELECT bt FROM baja) AS pt, coalesce(cuil_norm IN (SELECT bc FROM baja WHERE bc IS NOT NULL), false) AS pc FROM canon)
"""


# The white space that counts, as a class of DuckDB's regular expressions.
WS_SQL = r"\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def phone_sql(table: str, key: str) -> str:
    """CTEs up to `phones(id_fila, telefono, tv)` of a delivered table; `tv` is a letter for the type and the canonical number."""
    return f"""
WITH q1 AS (SELECT {key} AS id_fila, telefono, coalesce(telefono, '') AS t0 FROM {table}),
q2 AS (SELECT *, regexp_replace(t0, '^[{WS_SQL}]+|[{WS_SQL}]+$', '', 'g') AS tr, regexp_replace(split_part(t0, '/', 1), '[{WS_SQL}]+', '', 'g') AS tc FROM q1),
q3 AS (SELECT *, regexp_replace(tc, '[^0-9]', '', 'g') AS td FROM q2),
q4 AS (SELECT *, CASE WHEN td LIKE '0%' THEN substr(td, 2) ELSE td END AS tl FROM q3),
phones AS (SELECT id_fila, telefono, CASE
    WHEN regexp_matches(tr, '[a-zA-Z]') OR td = '' THEN 'i'
    WHEN starts_with(tc, '+549') THEN CASE WHEN length(td) = 13 THEN 'c+549' || substr(td, 4) ELSE 'i' END
    WHEN starts_with(tc, '+54') THEN CASE WHEN length(td) = 12 THEN 'f+54' || substr(td, 3) ELSE 'i' END
    WHEN td LIKE '549%' AND length(td) = 13 THEN 'c+549' || substr(td, 4)
    WHEN length(tl) BETWEEN 12 AND 14 AND substr(tl, length(tl) - 9, 2) = '15' THEN 'c+549' || substr(tl, 1, length(tl) - 10) || right(tl, 8)
    WHEN length(td) = 11 AND td LIKE '0%' THEN 'f+54' || substr(td, 2)
    WHEN length(td) = 10 AND td LIKE '15%' THEN 'i'
    WHEN length(td) = 10 AND tc NOT LIKE '+%' THEN 'a+54' || td ELSE 'i' END AS tv FROM q4)
"""


_SEGMENT = """CASE WHEN length(cuil_norm) <> 11 THEN 'desconocida' WHEN substr(cuil_norm, 1, 2) IN ('20', '23', '24', '27') THEN 'fisica'
WHEN substr(cuil_norm, 1, 2) IN ('30', '33', '34') THEN 'juridica' ELSE 'desconocida' END"""
_ALL = (
    _SCORE
    + _OPTOUT
    + f""",
full0 AS (SELECT s.*, {_SEGMENT} AS tipo_persona, CASE WHEN h.pt AND h.pc THEN 'ambos' WHEN h.pt THEN 'telefono' WHEN h.pc THEN 'cuil' END AS optout_via FROM scored s JOIN hit h USING (id_fila)),
full1 AS (SELECT * EXCLUDE (motivo), concat_ws('; ', CASE WHEN {_NAME_FILLER} THEN left(motivo, length(motivo) - length('; nombre de relleno +0')) ELSE motivo END,
  CASE WHEN tipo_persona = 'juridica' THEN 'persona jurídica (segmento no buscado) +0 → descarte' END, CASE WHEN optout_via IS NOT NULL THEN 'opt-out del cliente +0 → descarte' END,
  CASE WHEN {_NAME_FILLER} THEN 'nombre de relleno +0' END) AS motivo FROM full0)
SELECT id_fila, tipo_persona, optout_via, puntaje, CASE WHEN contains(motivo, '→ descarte') THEN 'descartado' ELSE prioridad END AS prioridad, motivo FROM full1
"""
)
_TENTHS = lambda top, bottom: f"CAST(floor((20 * ({top}) + {bottom}) / (2 * {bottom})) AS BIGINT)"


def _mutation_sql() -> str:
    total = " + ".join(f"CAST(substr(m, {i + 1}, 1) AS INT) * {w}" for i, w in enumerate((5, 4, 3, 2, 7, 6, 5, 4, 3, 2)))
    return f""",
mut AS (SELECT substr(cuil_norm, 1, p) || CAST((CAST(substr(cuil_norm, p + 1, 1) AS INT) + k) % 10 AS VARCHAR) || substr(cuil_norm, p + 2) AS m
  FROM canon, (SELECT unnest(range(0, 11)) AS p) ps, (SELECT unnest(range(1, 10)) AS k) ks WHERE cuil_valido),
judged AS (SELECT m, substr(m, 1, 2) IN ('20', '23', '24', '27', '30', '33', '34') AS shaped, ({total}) % 11 AS r FROM mut)
SELECT CAST(count(*) / 99 AS BIGINT) AS base, count(*) AS mutaciones,
  count(*) FILTER (shaped AND r <> 1 AND CAST(substr(m, 11, 1) AS INT) = CASE WHEN r = 0 THEN 0 ELSE 11 - r END) AS no_detectadas FROM judged
"""


BOOLEANS = ("cuil_valido", "cuil_dudoso", "es_duplicado", "en_zona", "marcado")


def _csv(c: str, boolean: bool = False) -> str:
    v = f"coalesce({'upper' * boolean}(CAST({c} AS VARCHAR)), '')"
    return f"CASE WHEN regexp_matches({v}, '[,\"\\n\\r]') THEN '\"' || replace({v}, '\"', '\"\"') || '\"' ELSE {v} END"


def _tag(tag: str) -> str:
    return f"count(*) FILTER (prioridad = 'descartado' AND contains(motivo, '{tag}') AND contains(motivo, '→ descarte'))"


SQL = {
    "n1_phone": _CANON + "SELECT id_fila, telefono_norm, telefono_tipo, telefono_match FROM canon",
    "n2_taxid": _CANON + "SELECT id_fila, cuil_norm, cuil_valido, cuil_dudoso FROM canon",
    "n5_locality": _CANON + f"SELECT id_fila, {_FOLDED} AS plegada, {_CORE} AS nucleo FROM leads",
    "n8_dates": _CANON + _flags("canon", "f") + "SELECT id_fila, dias_antiguedad, frescura, motivo_frescura FROM f",
    "n12_person": _CANON + """SELECT CASE WHEN length(cuil_norm) <> 11 THEN 'desconocida' WHEN substr(cuil_norm, 1, 2) IN ('20', '23', '24', '27') THEN 'fisica'
WHEN substr(cuil_norm, 1, 2) IN ('30', '33', '34') THEN 'juridica' ELSE 'desconocida' END AS tipo_persona, count(*) AS filas FROM canon GROUP BY 1""",
    "n13_filler_phone": _CANON + f"SELECT id_fila FROM canon WHERE {_FILLER}",
    "n14_filler_name": _CANON + f"SELECT id_fila FROM leads WHERE {_NAME_FILLER}",
    "n15_signed": _CANON + "SELECT id_fila, printf('%+d', id_fila % 41 - 20) AS firmado FROM leads",
    "n16_completeness": _CANON + "SELECT id_fila, CAST(completos AS INT) AS completos FROM canon",
    "flt_p3_coverage": _CANON + _flags("canon", "f") + "SELECT id_fila, sin_localidad, en_zona, marcado, motivo_descarte FROM f",
    "flt_p5_segment": _CANON + """, t AS (SELECT id_fila, CASE WHEN length(cuil_norm) <> 11 THEN 'desconocida' WHEN substr(cuil_norm, 1, 2) IN ('20', '23', '24', '27') THEN 'fisica'
WHEN substr(cuil_norm, 1, 2) IN ('30', '33', '34') THEN 'juridica' ELSE 'desconocida' END AS tipo_persona FROM canon)
SELECT *, tipo_persona = 'juridica' AS descarte_segmento, CASE WHEN tipo_persona = 'juridica' THEN 'persona jurídica (segmento no buscado)' ELSE '' END AS motivo_segmento FROM t""",
    "j1_optout": _CANON + _OPTOUT + "SELECT id_fila, CASE WHEN pt AND pc THEN 'ambos' WHEN pt THEN 'telefono' ELSE 'cuil' END AS optout_via FROM hit WHERE pt OR pc",
    "j2_optout_counts": _CANON + _OPTOUT + """SELECT count(*) AS filas, count(*) FILTER (telefono_norm = '' AND trim(telefono) <> '') AS telefonos_ilegibles,
count(*) FILTER (id_fila % 46 = 0 AND length(cuil_norm) <> 11 AND trim(cuil) <> '') AS cuils_ilegibles FROM baja""",
    "a1_components": _CANON + _COMPS + "SELECT id_fila, comp FROM comps",
    "a2_winner": _CANON + _COMPS + "SELECT comp, ganador, n FROM won",
    "a4_marking": _CANON + _COMPS + "SELECT id_fila, telefono_tipo, es_duplicado, duplicado_de, motivo_duplicado FROM marked",
    "g1_score": _CANON + _SCORE + "SELECT id_fila, puntaje FROM scored",
    "g2_motive": _CANON + _SCORE + "SELECT id_fila, motivo FROM scored",
    "g3_law": _CANON + _SCORE + "SELECT count(*) AS filas, count(*) FILTER (list_sum(list_transform(regexp_extract_all(motivo, '[+-][0-9]+'), lambda x: CAST(x AS INT))) <> puntaje) AS desvios FROM scored",
    "g4_priority": _CANON + _SCORE + "SELECT id_fila, prioridad FROM scored",
    "o1_rank": _CANON + _SCORE + f"SELECT {_RANKED} AS orden, {', '.join(AUDIT)} FROM scored",
    "r1_counts": _CANON + _SCORE + """SELECT count(*) AS total, count(*) FILTER (prioridad = 'alta') AS alta, count(*) FILTER (prioridad = 'media') AS media,
count(*) FILTER (prioridad = 'descartado') AS descartado FROM scored""",
    "r2_reasons": _CANON + _SCORE + f"SELECT {', '.join(f'{_tag(t)} AS {k}' for k, t in report.TAGS.items())}, count(*) FILTER (prioridad = 'descartado' AND NOT contains(motivo, '→ descarte')) AS puntaje_bajo FROM scored",
    "r5_origin_freq": _CANON + "SELECT CASE WHEN trim(origen) = '' THEN '(vacio)' ELSE trim(origen) END AS origen, count(*) AS filas FROM leads GROUP BY 1",
    "r7_extra_rows": _CANON + """, k AS (SELECT 'cuil_norm' AS clave, cuil_norm AS v, count(*) AS n FROM canon GROUP BY 1, 2 UNION ALL SELECT 'telefono_match', telefono_match, count(*) FROM canon GROUP BY 1, 2)
SELECT clave, CAST(sum(CASE WHEN v <> '' THEN n - 1 ELSE 0 END) AS BIGINT) AS sobrantes, CAST(sum(n - 1) AS BIGINT) AS con_vacios FROM k GROUP BY 1""",
    "r9_mutations": _CANON + _mutation_sql(),
    "r3_derived": _CANON + _SCORE + f""", c AS (SELECT count(*) AS total, count(*) FILTER (prioridad = 'alta') AS alta, count(*) FILTER (prioridad = 'media') AS media,
count(*) FILTER (prioridad = 'descartado') AS gone, {_tag('duplicado')} AS dup FROM scored)
SELECT total - dup AS unicos, alta + media AS llamables, {_TENTHS('gone * 4', 60)} AS decimas_hora_4, {_TENTHS('gone * 2', 60)} AS decimas_hora_2, {_TENTHS('gone * 5', 60)} AS decimas_hora_5,
{_TENTHS('alta * 100', 'total')} AS decimas_pct_alta, {_TENTHS('media * 100', 'total')} AS decimas_pct_media FROM c""",
    "k2_audit_lines": _CANON + _SCORE + f"SELECT {' || chr(44) || '.join(_csv(c, c in BOOLEANS) for c in AUDIT)} AS linea FROM scored",
    "g4_everything": _CANON + _ALL,
    "j2_optout_values": _CANON + _OPTOUT + "SELECT DISTINCT 'telefono' AS clase, bt AS valor FROM baja WHERE bt <> '' UNION ALL SELECT DISTINCT 'cuil', bc FROM baja WHERE bc IS NOT NULL",
    "j7_differences": _CANON + _flags("canon", "f") + _flags("canon", "g", EARLIER) + """
SELECT f.id_fila, 'dias_antiguedad' AS columna, CAST(g.dias_antiguedad AS VARCHAR) AS antes, CAST(f.dias_antiguedad AS VARCHAR) AS despues FROM f JOIN g USING (id_fila) WHERE f.dias_antiguedad IS DISTINCT FROM g.dias_antiguedad
UNION ALL SELECT f.id_fila, 'frescura', g.frescura, f.frescura FROM f JOIN g USING (id_fila) WHERE f.frescura <> g.frescura
UNION ALL SELECT f.id_fila, 'motivo_frescura', g.motivo_frescura, f.motivo_frescura FROM f JOIN g USING (id_fila) WHERE f.motivo_frescura <> g.motivo_frescura""",
    "n3_match_key": phone_sql("leads_prueba_sintetico_1", "lead_id") + """, k AS (SELECT id_fila, regexp_replace(substr(tv, 2), '[^0-9]', '', 'g') AS n FROM phones)
SELECT id_fila, CASE WHEN length(n) >= 10 THEN right(n, 10) ELSE '' END AS telefono_match FROM k""",
    "n4_position": _CANON + "SELECT id_fila, row_number() OVER (ORDER BY origen, id_fila DESC) AS posicion FROM leads",
    "n7_name_fold": f"SELECT lead_id AS id_fila, regexp_replace(regexp_replace(lower(strip_accents(coalesce(nombre, ''))), '^[{WS_SQL}]+|[{WS_SQL}]+$', '', 'g'), '[{WS_SQL}]+', ' ', 'g') AS plegado FROM leads_prueba_sintetico_1",
    "s14_coerce": f"SELECT lead_id AS id_fila, {', '.join(f"coalesce({c}, '') AS {c}" for c in CANONICAL)} FROM leads_prueba_sintetico_1",
    "flt_p1_blank": f"SELECT archivo_id, count(*) AS registros FROM leads_adversario_2 WHERE regexp_matches(c0, '[^{WS_SQL}]') GROUP BY 1",
    "k1_commercial_lines": _CANON + _SCORE + f"SELECT {' || chr(44) || '.join(_csv(c) for c in COMMERCIAL)} AS linea FROM scored",
}
