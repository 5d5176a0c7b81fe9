"""Queries and SQL of the operators of this package."""

from __future__ import annotations

from tamiz.llm import components, encodings, leakage, mapping, survivors, tokens, truncation

QUERIES = {
    "p3_found": survivors.found,
    "p3_truth": survivors.truth,
    "p3_agreement": survivors.agreement,
    "p4_found": mapping.found,
    "p5_found": components.found_groups,
    "p7_found": encodings.found,
    "p8_ids": tokens.ids,
    "p9_found": leakage.found,
    "p10_found": truncation.found,
    "p10_rates": truncation.rates,
}

_GROUPS = """
WITH RECURSIVE e AS ({edges}),
sym AS (SELECT u, v FROM e WHERE u <> v UNION SELECT v, u FROM e WHERE u <> v),
reach(id, l) AS (SELECT DISTINCT u, u FROM sym UNION SELECT sym.v, reach.l FROM reach JOIN sym ON sym.u = reach.id),
g AS (SELECT id, min(l) AS grupo FROM reach GROUP BY id)
"""
_DECLARED = "SELECT id_fila AS u, duplicado_de AS v FROM salida_adv1 WHERE duplicado_de IN (SELECT id_fila FROM salida_adv1)"
_BY_KEY = " UNION ALL ".join(f"SELECT min(id_fila) OVER (PARTITION BY {k}), id_fila FROM salida_adv1 WHERE {k} <> ''" for k in ("cuil_norm", "telefono_match"))

_WS = r"\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def _full(c: str) -> str:
    return f"coalesce(regexp_matches({c}, '[^{_WS}]'), false)"


_DAY = f"regexp_replace(coalesce(fecha_carga, ''), '^[{_WS}]+|[{_WS}]+$', '', 'g')"
_ISO = (
    f"CASE WHEN regexp_full_match({_DAY}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN {_DAY} WHEN regexp_full_match({_DAY}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
    f"THEN substr({_DAY}, 7, 4) || '-' || substr({_DAY}, 4, 2) || '-' || substr({_DAY}, 1, 2) END"
)
_WEIGHED = " + ".join(f"try_cast(substr(d, {i + 1}, 1) AS INT) * {w}" for i, w in enumerate((5, 4, 3, 2, 7, 6, 5, 4, 3, 2, 1)))
_CAN = {
    "nombre": _full("nombre"), "cuil": f"coalesce(length(d) = 11 AND substr(d, 1, 2) IN ('20', '23', '24', '27', '30', '33', '34') AND ({_WEIGHED}) % 11 = 0, false)",
    "telefono": "coalesce(telefono_norm <> '', false)", "localidad": _full("localidad"), "origen": _full("origen"), "fecha_carga": "dia IS NOT NULL",
}
_COUNT = " + ".join(f"CAST({_full(c)} AS INT)" for c in _CAN)

SQL = {
    "p3_found": _GROUPS.format(edges=_DECLARED)
    + f""",
t0 AS (SELECT *, regexp_replace(coalesce(cuil, ''), '[^0-9]', '', 'g') AS d, CASE WHEN {_ISO} NOT LIKE '00%' THEN try_cast({_ISO} AS DATE) END AS dia, {_COUNT} AS llenos FROM salida_adv1),
t AS (SELECT g.grupo, t0.*, (coalesce(dia, DATE '0001-01-01'), llenos, -id_fila) AS orden FROM t0 JOIN g ON g.id = t0.id_fila)
"""
    + " UNION ALL ".join(f"SELECT grupo, '{c}' AS campo, arg_max(id_fila, orden) AS id_fila FROM t WHERE {x} GROUP BY grupo" for c, x in _CAN.items()),
    "p5_found": _GROUPS.format(edges=f"{_DECLARED} UNION ALL {_BY_KEY}") + "SELECT id AS id_fila, grupo FROM g",
    "p9_found": """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(coalesce(text, ''))), '[a-z0-9]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(strip_accents(coalesce(text, ''))), '[a-z0-9]+') AS w FROM items_evaluacion),
dw AS (SELECT doc_id, array_to_string(w[k : k + 12], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d)),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 12], ' ') AS run FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i))
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (run)
""",
}
