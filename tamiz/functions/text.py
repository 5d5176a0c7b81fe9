"""Text canonicalisation: one white-space class, blank test, accent folding, locality core."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that counts in every trim and blank test.
WS_BODY = r"\s\x0B\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
WS = f"[{WS_BODY}]"

#: The same class for Python's re / regex modules.
PY_WS = "[\t\n\x0b\x0c\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def trim_ws(c: Column) -> Column:
    """Trim with the shared white-space class; null stays null."""
    return F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")


def is_blank(c: Column) -> Column:
    """Null, empty or only white space. Never null."""
    return ~F.coalesce(c.rlike(rf"[^{WS_BODY}]"), F.lit(False))


def squeeze_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS}+", " ")


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Characters whose canonical decomposition is one base character plus marks of
    U+0300-036F, and those bases; generated from the Unicode database up to U+FFFF."""
    src, dst = [], []
    for cp in range(0xC0, 0x10000):
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3:
            continue
        ch = chr(cp)
        full = unicodedata.normalize("NFD", ch)
        if full == ch:
            continue
        bare = "".join(x for x in full if not "\u0300" <= x <= "\u036f")
        if len(bare) == 1 and bare != ch:
            src.append(ch)
            dst.append(bare)
    return "".join(src), "".join(dst)


def strip_marks(c: Column) -> Column:
    """NFD and removal of U+0300-036F, without a UDF."""
    src, dst = accent_table()
    return F.regexp_replace(F.translate(c, src, dst), r"[\u0300-\u036F]", "")


def fold(c: Column) -> Column:
    """Name / header / locality key: no marks, lower case, trimmed, single spaces."""
    return squeeze_ws(trim_ws(F.lower(strip_marks(text_or_empty(c)))))


def locality_core(c: Column) -> Column:
    """The folded locality without one trailing parenthesis and without what follows a comma."""
    t = F.regexp_replace(fold(c), rf"{WS}*\([^)]*\){WS}*\z", "")
    t = F.regexp_replace(t, r",.*\z", "")
    return squeeze_ws(trim_ws(t))


def signed(c: Column) -> Column:
    """+15, +0, -10."""
    return F.format_string("%+d", c)


def py_fold(s: str | None) -> str:
    """fold() for driver-side configuration values."""
    import re

    t = "".join(x for x in unicodedata.normalize("NFD", s or "") if not "\u0300" <= x <= "\u036f").lower()
    return re.sub(f"{PY_WS}+", " ", t).strip(" ")


def py_trim(s: str | None) -> str:
    import re

    return re.sub(rf"\A{PY_WS}+|{PY_WS}+\Z", "", s or "")
