"""Plans 00 to 14 as chains of transforms over one lead table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.dates import age_bucket, age_days, age_reasons, load_date, resolve_cutoff
from tamiz.functions.phone import match_key, with_phone
from tamiz.functions.taxid import with_taxid
from tamiz.functions.text import text_or_empty
from tamiz.operators.dedup import mark_duplicates
from tamiz.operators.rules import rank_order, with_coverage, with_optout, with_score, with_segment
from tamiz.plans.config import CANONICAL, ConfigError, PlanConfig

COMMERCIAL = (*CANONICAL, "puntaje", "prioridad", "motivo")
AUDIT = (
    *CANONICAL, "telefono_norm", "telefono_tipo", "cuil_norm", "cuil_valido", "cuil_dudoso", "telefono_match", "id_fila", "es_duplicado",
    "duplicado_de", "motivo_duplicado", "en_zona", "marcado", "motivo_descarte", "fecha_corte_usada", "dias_antiguedad", "frescura",
    "motivo_frescura", "puntaje", "prioridad", "motivo",
)
PLANS = ("00", "01", "02", "03", "04", "05", "06", "07", "08", "11", "12", "14")


def coerce(df: DataFrame) -> DataFrame:
    """Lead columns as text, null as ''; `extra_*` and the reading warning pass, everything else stays behind."""
    tail = [c for c in df.columns if c.startswith("extra_") or c in ("advertencia_entrada", "id_fila")]
    texts = [text_or_empty(F.col(f"`{c}`")).alias(c) for c in (*CANONICAL, *[c for c in tail if c != "id_fila"])]
    return df.select("id_fila", *texts)


def with_age(df: DataFrame, cutoff: str | None) -> DataFrame:
    day, text = resolve_cutoff(cutoff)
    days = age_days(load_date(F.col("fecha_carga")), day)
    df = df.withColumns({"fecha_corte_usada": F.lit(text), "dias_antiguedad": days})
    return df.withColumns({"frescura": age_bucket(F.col("dias_antiguedad")), "motivo_frescura": age_reasons(F.col("fecha_carga"), F.col("dias_antiguedad"))})


def build(leads: DataFrame, plan: str = "08", config: PlanConfig | None = None, optout: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The lead table after `plan`; rows in are rows out. `leads` has the six columns and a unique `id_fila` (file position).

    The duplicate search is the only wide step before the final order, which `rank` columns or sinks apply.
    """
    if plan not in PLANS:
        raise ConfigError(f"no plan {plan!r}; plans are {', '.join(PLANS)}")
    c = config or PlanConfig()
    n = int(plan)
    df = coerce(leads)
    if n >= 1:
        df = with_phone(df, "telefono")
    if n >= 2:
        df = with_taxid(df, "cuil")
    if n >= 3:
        df = mark_duplicates(df.withColumn("telefono_match", match_key(F.col("telefono_norm"))))
    if n >= 4:
        df = with_coverage(df, c.zone)
    if n >= 5:
        df = with_age(df, c.cutoff)
    if n >= 12:
        df = with_segment(df, c.segment)
    if n >= 14 and optout is not None:
        df = with_optout(df, *optout)
    if n >= 6:
        df = with_score(df, c.scoring, c.filler, c.optout)
    return df


def ranked(df: DataFrame) -> DataFrame:
    """The table in its final order."""
    return df.orderBy(*rank_order())


def audit_columns(df: DataFrame) -> list[str]:
    """The 26 audit columns and, sorted, the optional ones that are there."""
    tail = sorted(c for c in df.columns if c.startswith("extra_") or c in ("advertencia_entrada", "tipo_persona", "optout_via"))
    return [*AUDIT, *tail]
