"""Argentine phone numbers: canonical form, type, match key, filler test.

The rules are a chain of anchored rewrites in which every step uses the one before it
exactly once, so the expression stays linear however often the optimizer inlines it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import WS, text_or_empty, trim_ws

# The phone types, most specific first.
TYPES = ("celular", "fijo", "ambiguo", "invalido")

# Cleaning: letters void the value (before the slash is looked at), only what stands
# left of a slash counts, and the international prefix becomes one letter.
_CLEAN = (
    (r"(?s)\A.*[a-zA-Z].*\z", ""),
    (r"(?s)/.*\z", ""),
    (f"{WS}+", ""),
    (r"\A\+549", "M"),
    (r"\A\+54", "F"),
    (r"\A\+", "P"),
    (r"[^0-9MFP]", ""),
)
# Rules in order; a result starts with a small letter and no later rule touches it.
_RULES = (
    (r"\AM([0-9]{10})\z", r"c+549$1"),
    (r"\AF([0-9]{10})\z", r"f+54$1"),
    (r"\AP?549([0-9]{10})\z", r"c+549$1"),
    (r"\AP?0?+([0-9]{2,4})15([0-9]{8})\z", r"c+549$1$2"),
    (r"\AP?0([0-9]{10})\z", r"f+54$1"),
    (r"\A(?!15)([0-9]{10})\z", r"a+54$1"),
    (r"\A[^cfa].*\z", ""),
)
_NAMES = ((r"\Ac.*\z", "celular"), (r"\Af\+.*\z", "fijo"), (r"\Aa\+.*\z", "ambiguo"), (r"\A\z", "invalido"))


def _rewrite(c: Column, steps) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


def _verdict(raw: Column) -> Column:
    return _rewrite(_rewrite(trim_ws(text_or_empty(raw)), _CLEAN), _RULES)


def phone_norm(raw: Column) -> Column:
    """Canonical number, '' when invalid; null, empty and blank are invalid."""
    return F.substring(_verdict(raw), 2, 40)


def phone_type(raw: Column) -> Column:
    """celular, fijo, ambiguo or invalido."""
    return _rewrite(_verdict(raw), _NAMES)


def with_phone(df: DataFrame, raw: str, norm: str = "telefono_norm", kind: str = "telefono_tipo") -> DataFrame:
    return df.withColumns({norm: phone_norm(F.col(raw)), kind: phone_type(F.col(raw))})


def match_key(norm: Column) -> Column:
    """Last ten digits of a canonical number, '' below ten: the mobile 9 does not count."""
    return F.regexp_extract(F.regexp_replace(text_or_empty(norm), "[^0-9]", ""), r"[0-9]{10}\z", 0)


def is_filler_phone(norm: Column, sequences: list[str], tail: int) -> Column:
    """A listed ten-digit sequence, or the last `tail` digits all alike."""
    alike = rf"\A(?=[0-9]{{10}}\z).*([0-9])\1{{{tail - 1}}}\z"
    listed = "".join(rf"|\A{x}\z" for x in sequences)
    return match_key(norm).rlike(alike + listed)
