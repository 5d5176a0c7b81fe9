"""Queries and SQL of the general problems: record loading, timestamps, profile."""

from __future__ import annotations

from tamiz.operators import load_records, profile, timestamps
from tamiz.plans.reference_queries import WS_SQL, phone_sql

QUERIES = {
    "p1_found": load_records.found,
    "p1_phones": lambda s, d: load_records.bad_phones(s.read.parquet(f"{d}/leads_prueba_sintetico_1.parquet")),
    "p2_found": timestamps.found,
    "p6_found": profile.found,
    "p6_profile": profile.table_profile,
    "p6_shifts": profile.numeric_shifts,
}

_P6_COLUMNS = ("telefono_tipo", "cuil_valido", "en_zona")

# The columns of salida_adv1 beside the load, by kind.
_TEXTS = "nombre cuil telefono localidad origen fecha_carga telefono_norm telefono_tipo cuil_norm cuil_valido cuil_dudoso telefono_match es_duplicado motivo_duplicado en_zona marcado motivo_descarte fecha_corte_usada frescura motivo_frescura prioridad motivo".split()
_NUMBERS = "id_fila archivo_id duplicado_de dias_antiguedad puntaje".split()


def _profile_sql(c: str) -> str:
    text = c in _TEXTS
    pattern = profile.PATTERNS.get(c)
    wrong = f"count(*) FILTER ({c} <> '' AND NOT regexp_full_match({c}, '{pattern}'))" if pattern else "CAST(NULL AS BIGINT)"
    empty = f"count(*) FILTER ({c} = '')" if text else "CAST(0 AS BIGINT)"
    return (
        f"SELECT carga_id AS carga, '{c}' AS columna, count(*) AS filas, count(*) FILTER ({c} IS NULL) AS nulos, {empty} AS vacios, count(DISTINCT {c}) AS distintos, "
        f"CAST(min({c}) AS VARCHAR) AS minimo, CAST(max({c}) AS VARCHAR) AS maximo, {wrong} AS violaciones FROM salida_adv1 GROUP BY 1"
    )


SQL = {
    "p1_phones": phone_sql("leads_prueba_sintetico_1", "lead_id") + f"SELECT id_fila AS registro_id, 'valor' AS motivo FROM phones WHERE tv = 'i' AND regexp_matches(telefono, '[^{WS_SQL}]')",
    "p6_profile": " UNION ALL ".join(map(_profile_sql, [*_TEXTS, *_NUMBERS])),
    "p6_found": """
WITH t AS (
  SELECT id_fila, carga_id, 'telefono_tipo' AS columna, telefono_tipo AS v FROM salida_adv1
  UNION ALL SELECT id_fila, carga_id, 'cuil_valido', cuil_valido FROM salida_adv1
  UNION ALL SELECT id_fila, carga_id, 'en_zona', en_zona FROM salida_adv1),
c AS (SELECT columna, carga_id, coalesce(v, '') AS v, count(*) AS n FROM t WHERE carga_id IS NOT NULL GROUP BY 1, 2, 3),
tot AS (SELECT columna, carga_id, sum(n) AS total FROM c GROUP BY 1, 2),
vals AS (SELECT DISTINCT columna, v FROM c),
dense AS (SELECT columna, carga_id, v, coalesce(n, 0) / total AS p FROM tot JOIN vals USING (columna) LEFT JOIN c USING (columna, carga_id, v)),
m AS (SELECT *, median(p) OVER (PARTITION BY columna, v) AS med FROM dense)
SELECT columna, 'patron' AS hallazgo, CAST(id_fila AS BIGINT) AS clave FROM t
WHERE v <> '' AND NOT (CASE WHEN columna = 'telefono_tipo' THEN v IN ('celular', 'fijo', 'ambiguo', 'invalido') ELSE v IN ('TRUE', 'FALSE') END)
UNION ALL
SELECT DISTINCT columna, 'cambio', CAST(carga_id AS BIGINT) FROM m WHERE round(abs(p - med), 12) > 0.21
""",
    "p6_shifts": """
WITH t AS (
  SELECT carga_id AS carga, 'puntaje' AS columna, CAST(puntaje AS HUGEINT) AS x FROM salida_adv1 WHERE puntaje IS NOT NULL
  UNION ALL SELECT carga_id, 'dias_antiguedad', CAST(dias_antiguedad AS HUGEINT) FROM salida_adv1 WHERE dias_antiguedad IS NOT NULL),
s AS (SELECT carga, columna, CAST(count(*) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS s1, CAST(sum(x * x) AS DOUBLE) AS s2 FROM t GROUP BY 1, 2),
j AS (SELECT *, sum(n) OVER w - n AS m, sum(s1) OVER w - s1 AS r1, sum(s2) OVER w - s2 AS r2 FROM s WINDOW w AS (PARTITION BY columna)),
v AS (SELECT carga, columna, s1 / n AS mean, r1 / m AS rest, greatest(s2 / n - (s1 / n) * (s1 / n), 0.0) AS var, greatest(r2 / m - (r1 / m) * (r1 / m), 0.0) AS var_rest FROM j)
SELECT carga, columna, round(mean, 6) AS media, round(sqrt(var), 6) AS desvio, round(rest, 6) AS media_resto,
       round((mean - rest) / nullif(sqrt((var + var_rest) / 2), 0.0), 6) AS diferencia FROM v
""",
}
