"""Impact numbers and their Markdown."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import is_blank, text_or_empty, trim_ws

# Minutes of a call, and the band of the estimate.
MINUTES, MINUTES_LOW, MINUTES_HIGH = 4, 2, 5
# A reason counts if the explanation holds its tag and a discard.
TAGS = {
    "sin_telefono": "sin teléfono", "fuera_zona": "fuera de zona", "duplicado": "duplicado",
    "telefono_relleno": "teléfono de relleno", "segmento": "segmento no buscado", "optout": "opt-out",
}


def metrics(df: DataFrame) -> DataFrame:
    """One row of conditional counts: total, alta, media, descartado, the overlapping reasons, low score. BIGINT, 0 for an empty table."""
    p, m = F.col("prioridad"), F.col("motivo")
    gone = ~F.coalesce(p.isin("alta", "media"), F.lit(False))
    labelled = F.coalesce(p == "descartado", F.lit(False))
    arrow = m.contains("→ descarte")
    reasons = [F.count_if(labelled & arrow & m.contains(tag)).alias(name) for name, tag in TAGS.items()]
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(p == "alta").alias("alta"), F.count_if(p == "media").alias("media"), F.count_if(gone).alias("descartado"),
        *reasons, F.count_if(labelled & ~arrow).alias("puntaje_bajo"),
    )


def origin_frequencies(df: DataFrame) -> DataFrame:
    """`origen, filas` of the trimmed origin as it came, `(vacio)` for blank."""
    key = F.when(is_blank(F.col("origen")), "(vacio)").otherwise(trim_ws(text_or_empty(F.col("origen"))))
    return df.groupBy(key.alias("origen")).agg(F.count(F.lit(1)).alias("filas"))


def one_decimal(x: float) -> str:
    """The exact binary value rounded half up to one decimal."""
    return str(Decimal(x).quantize(Decimal("0.1"), ROUND_HALF_UP))


def derived(m: dict) -> dict:
    """Unique and callable contacts, hours saved and their band, shares of the total."""
    total, gone = m["total"], m["descartado"]
    return {
        "unicos": total - m["duplicado"], "llamables": m["alta"] + m["media"], "horas": one_decimal(gone * MINUTES / 60),
        "horas_bajo": one_decimal(gone * MINUTES_LOW / 60), "horas_alto": one_decimal(gone * MINUTES_HIGH / 60),
        "pct_alta": one_decimal(m["alta"] * 100 / total) if total else "0.0", "pct_media": one_decimal(m["media"] * 100 / total) if total else "0.0",
    }


def derived_row(m: DataFrame) -> DataFrame:
    """The numbers of `derived` as columns beside one row of `metrics`: exact tenths, halves up, by integer arithmetic."""
    def tenths(top: Column, bottom: Column) -> Column:
        return F.floor((20 * top + bottom) / (2 * bottom)).cast("bigint")

    gone, total = F.col("descartado"), F.col("total")
    hours = [tenths(gone * n, F.lit(60)).alias(f"decimas_hora_{n}") for n in (MINUTES, MINUTES_LOW, MINUTES_HIGH)]
    share = [F.when(total > 0, tenths(F.col(c) * 100, total)).otherwise(0).cast("bigint").alias(f"decimas_pct_{c}") for c in ("alta", "media")]
    return m.select((total - F.col("duplicado")).alias("unicos"), (F.col("alta") + F.col("media")).alias("llamables"), *hours, *share)


def _table(head: tuple[str, ...], rows: list[tuple]) -> list[str]:
    return ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *["| " + " | ".join(map(str, r)) + " |" for r in rows], ""]


def render(m: dict, cutoff: str) -> str:
    """The report: data quality and zone always, segment, opt-out and filler only if they occur; what was counted apart from what is assumed."""
    d = derived(m)
    quality = [("Ningún teléfono al que llamar", m["sin_telefono"])]
    quality += [("Número inventado", m["telefono_relleno"])] * (m["telefono_relleno"] > 0)
    quality += [("Repite a otro contacto", m["duplicado"])]
    quality += [("Sólo por puntaje", m["puntaje_bajo"])] * (m["puntaje_bajo"] > 0)
    out = ["# Qué deja esta lista", "", f"Antigüedades al {cutoff}. Todo lo contado sale del archivo; los minutos por llamada son un supuesto.", ""]
    out += ["## Contado en el archivo", "", *_table(("Contactos", "N"), [("Todos", m["total"]), ("Sin repetidos", d["unicos"]), ("Para llamar", d["llamables"]), ("Fuera", m["descartado"])])]
    out += ["## Para llamar", "", *_table(("Prioridad", "N", "De todos"), [("Alta", m["alta"], d["pct_alta"] + "%"), ("Media", m["media"], d["pct_media"] + "%")])]
    out += ["## Por qué quedan fuera", "", "### El dato no sirve", "", *_table(("Causa", "N"), quality)]
    out += ["### El lugar no se atiende", "", *_table(("Causa", "N"), [("Localidad fuera de la zona", m["fuera_zona"])])]
    for key, title, text in (("segmento", "No es a quien se busca", "Otro tipo de persona"), ("optout", "Pidió que no lo llamen", "Está en la lista de bajas")):
        if m[key] > 0:
            out += [f"### {title}", "", *_table(("Causa", "N"), [(text, m[key])])]
    out += ["Las causas se superponen: quien tiene dos figura en ambas.", "", "## Supuesto, no medido", ""]
    out += _table(("Si cada llamada lleva", "Horas que no se gastan"), [(f"{MINUTES} minutos", d["horas"]), (f"{MINUTES_LOW} minutos", d["horas_bajo"]), (f"{MINUTES_HIGH} minutos", d["horas_alto"])])
    return "\n".join(out)
