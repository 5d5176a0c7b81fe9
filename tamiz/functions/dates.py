"""The two strict load-date forms, age in days and age bucket."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import is_blank, py_trim, text_or_empty, trim_ws

_DMY = r"\A([0-9]{2})/([0-9]{2})/([0-9]{4})\z"
_ISO = r"\A(?!00)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def load_date(c: Column) -> Column:
    """DATE of `yyyy-MM-dd` or `dd/MM/yyyy`, null for anything else and for years below 100."""
    iso = F.regexp_replace(trim_ws(text_or_empty(c)), _DMY, "$3-$2-$1")
    return F.regexp_extract(iso, _ISO, 0).try_cast("date")


def date_reasons(c: Column) -> Column:
    """`fecha vacia`, `fecha ilegible`, `fecha ambigua` or ''."""
    both_low = trim_ws(c).rlike(r"\A(?:0[0-9]|1[0-2])/(?:0[0-9]|1[0-2])/[0-9]{4}\z")
    return F.when(is_blank(c), "fecha vacia").when(load_date(c).isNull(), "fecha ilegible").when(both_low, "fecha ambigua").otherwise("")


def age_days(parsed: Column, cutoff: dt.date) -> Column:
    return F.datediff(F.lit(cutoff), parsed)


def age_bucket(days: Column) -> Column:
    """<=15 alta, <=45 media, <=90 baja, above fria; negative or unknown `sin dato`."""
    return (
        F.when(days.isNull() | (days < 0), "sin dato").when(days <= 15, "alta").when(days <= 45, "media").when(days <= 90, "baja").otherwise("fria")
    )


def age_reasons(raw: Column, days: Column) -> Column:
    base = date_reasons(raw)
    late = F.when(days < 0, "fecha futura").otherwise("")
    return F.array_join(F.filter(F.array(base, late), lambda x: x != ""), "; ")


def resolve_cutoff(value: str | None = None) -> tuple[dt.date, str]:
    """The cutoff as a date and as written; today in UTC by default. Raises ValueError if it is no date."""
    text = value or dt.datetime.now(dt.timezone.utc).date().isoformat()
    t = py_trim(text)
    iso, dmy = re.fullmatch(r"([0-9]{4})-([0-9]{2})-([0-9]{2})", t), re.fullmatch(r"([0-9]{2})/([0-9]{2})/([0-9]{4})", t)
    if not (iso or dmy):
        raise ValueError(f"fecha de corte invalida: {text}")
    y, m, d = (int(x) for x in (iso.groups() if iso else reversed(dmy.groups())))
    if y < 100:
        raise ValueError(f"fecha de corte invalida: {text}")
    return dt.date(y, m, d), text
