"""Tax ids: digits, check digit, doubtful remainder, person type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import text_or_empty

# Weights of the first ten digits; valid prefixes by person type.
WEIGHTS = (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)
PERSON_PREFIXES = ("20", "23", "24", "27")
COMPANY_PREFIXES = ("30", "33", "34")
_SHAPE = rf"\A(?:{'|'.join(PERSON_PREFIXES + COMPANY_PREFIXES)})[0-9]{{9}}\z"


def taxid_digits(c: Column) -> Column:
    return F.regexp_replace(text_or_empty(c), "[^0-9]", "")


def _remainder(c: Column, weights: tuple[int, ...]) -> Column:
    """Weighted digit sum modulo 11 of a well-formed id, null for any other."""
    shaped = F.regexp_extract(taxid_digits(c), _SHAPE, 0)
    digits = F.slice(F.split(F.nullif(shaped, F.lit("")), ""), 1, len(weights))
    parts = F.zip_with(digits, F.array(*map(F.lit, weights)), lambda d, w: d.cast("int") * w)
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 11


def taxid_valid(c: Column) -> Column:
    """True iff eleven digits, known prefix and right check digit. Counting the check digit with
    weight 1 the sum must vanish modulo 11; remainder 1 would need a check digit of ten, so it fails by itself."""
    return F.coalesce(_remainder(c, (*WEIGHTS, 1)) == 0, F.lit(False))


def taxid_doubtful(c: Column) -> Column:
    """Remainder 1 under its own prefix: such an id would have been reissued."""
    return F.coalesce(_remainder(c, WEIGHTS) == 1, F.lit(False))


def with_taxid(df: DataFrame, raw: str, norm: str = "cuil_norm", valid: str = "cuil_valido", doubtful: str = "cuil_dudoso") -> DataFrame:
    """Digits, validity and the remainder-one mark; null and blank give '', false, false."""
    c = F.col(raw)
    return df.withColumns({norm: taxid_digits(c), valid: taxid_valid(c), doubtful: taxid_doubtful(c)})


def person_type(digits: Column) -> Column:
    """fisica / juridica by prefix of an eleven-digit id, else desconocida; the check digit does not count."""
    t = F.coalesce(digits, F.lit(""))
    for pattern, name in (
        (rf"\A(?:{'|'.join(PERSON_PREFIXES)})[0-9]{{9}}\z", "fisica"),
        (rf"\A(?:{'|'.join(COMPANY_PREFIXES)})[0-9]{{9}}\z", "juridica"),
        (r"(?s)\A(?!fisica\z|juridica\z).*\z", "desconocida"),
    ):
        t = F.regexp_replace(t, pattern, name)
    return t
