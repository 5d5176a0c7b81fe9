"""Literal cases of the expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tamiz.functions.dates import age_bucket, age_reasons, load_date, resolve_cutoff
from tamiz.functions.phone import is_filler_phone, match_key, phone_norm, phone_type
from tamiz.functions.taxid import person_type, taxid_digits, taxid_doubtful, taxid_valid
from tamiz.functions.text import fold, is_blank, locality_core, py_fold, signed

# Published phones with their type and canonical number.
PHONES = [
    ("+54 11 4161-7956", "fijo", "+541141617956"), ("+54 9 11 4161 7956", "celular", "+5491141617956"), ("549 11 4161 7956", "celular", "+5491141617956"),
    ("011 15 4161-7956", "celular", "+5491141617956"), ("11 15 6161 7956", "celular", "+5491161617956"), ("111561617956", "celular", "+5491161617956"),
    ("221 15 6161 7956", "celular", "+54922161617956"), ("(011) 4161-7956", "fijo", "+541141617956"), ("011-45551111", "fijo", "+541145551111"),
    ("1145551111", "ambiguo", "+541145551111"), ("  1155551111 ﻿", "ambiguo", "+541155551111"), ("1141617956 / 1165385561", "ambiguo", "+541141617956"),
    ("15-4161-7956", "invalido", ""), ("4161-7956", "invalido", ""), ("1141617956.0", "invalido", ""), ("1.14162E+09", "invalido", ""), ("sin  dato", "invalido", ""),
    ("N/D", "invalido", ""), ("0", "invalido", ""), ("11 1234 567890", "invalido", ""), ("", "invalido", ""), (None, "invalido", ""), ("+54 9 379739043", "invalido", ""),
    ("1145551111 / casa", "invalido", ""), ("9" * 500, "invalido", ""), ("+1 (555) 0116 9031", "invalido", ""),
]


def test_phone(spark):
    rows = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PHONES)], "i int, t string").select("i", phone_type(F.col("t")), phone_norm(F.col("t"))).collect()
    assert [(r[1], r[2]) for r in sorted(rows)] == [(p[1], p[2]) for p in PHONES]


def test_match_and_filler(spark):
    r = spark.createDataFrame([("+5491141617956",), ("",), ("+541111111111",), ("+541234567890",), (None,)], "t string")
    got = [tuple(x) for x in r.select(match_key(F.col("t")), is_filler_phone(F.col("t"), ["1234567890"], 7)).collect()]
    assert got == [("1141617956", False), ("", False), ("1111111111", True), ("1234567890", True), ("", False)]


@pytest.mark.parametrize("raw,digits,valid,doubtful,kind", [
    ("20-12345678-6", "20123456786", True, False, "fisica"), ("20-12345678-5", "20123456785", False, False, "fisica"), ("99-12345678-6", "99123456786", False, False, "desconocida"),
    ("30-6930", "306930", False, False, "desconocida"), ("", "", False, False, "desconocida"), (None, "", False, False, "desconocida"), ("30-71525390-9", "30715253909", None, None, "juridica"),
])
def test_taxid(spark, raw, digits, valid, doubtful, kind):
    c = F.lit(raw).cast("string")
    r = spark.range(1).select(taxid_digits(c), taxid_valid(c), taxid_doubtful(c), person_type(taxid_digits(c))).first()
    assert (r[0], r[3]) == (digits, kind)
    if valid is not None:
        assert (r[1], r[2]) == (valid, doubtful)


def test_taxid_brute(spark):
    """Every remainder: against the rule written out."""
    ids = [f"{p}{n:08d}{d}" for p in ("20", "27", "30") for n in range(41000000, 41000030) for d in range(10)]

    def rule(x):
        r = sum(int(a) * b for a, b in zip(x, (5, 4, 3, 2, 7, 6, 5, 4, 3, 2))) % 11
        return (r != 1 and int(x[10]) == (0 if r == 0 else 11 - r), r == 1)

    rows = spark.createDataFrame([(x,) for x in ids], "c string").select("c", taxid_valid(F.col("c")), taxid_doubtful(F.col("c"))).collect()
    assert all((r[1], r[2]) == rule(r[0]) for r in rows) and len(rows) == len(ids)


def test_dates(spark):
    cases = [("2026-07-28", "2026-07-28", ""), ("28/07/2026", "2026-07-28", ""), ("05/06/2026", "2026-06-05", "fecha ambigua"), ("2026-02-30", None, "fecha ilegible"),
             ("0050-01-01", None, "fecha ilegible"), ("", None, "fecha vacia"), (" ", None, "fecha vacia"), (None, None, "fecha vacia"), ("10-abr-26", None, "fecha ilegible"), (" 2026-01-02 ", "2026-01-02", "")]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string").select("i", load_date(F.col("t")).cast("string"), age_reasons(F.col("t"), F.lit(1))).collect()
    assert [(r[1], r[2]) for r in sorted(rows)] == [(c[1], c[2]) for c in cases]
    buckets = spark.createDataFrame([(-1,), (0,), (15,), (16,), (45,), (46,), (90,), (91,), (None,)], "d int").select(age_bucket(F.col("d"))).collect()
    assert [b[0] for b in buckets] == ["sin dato", "alta", "alta", "media", "media", "baja", "baja", "fria", "sin dato"]


def test_cutoff():
    assert resolve_cutoff("28/07/2026") == (dt.date(2026, 7, 28), "28/07/2026")
    for bad in ("2026-13-01", "mañana", "0026-01-01"):
        with pytest.raises(ValueError):
            resolve_cutoff(bad)


def test_text(spark):
    c = F.col("t")
    rows = spark.createDataFrame([("  MORÓN  (Buenos Aires) ",), ("Ramos Mejía, BA",), ("﻿ 　",), (None,)], "t string").select(fold(c), locality_core(c), is_blank(c)).collect()
    assert [tuple(r) for r in rows] == [("moron (buenos aires)", "moron", False), ("ramos mejia, ba", "ramos mejia", False), ("", "", True), ("", "", True)]
    assert py_fold(" MORÓN  x ") == "moron x"
    assert [r[0] for r in spark.createDataFrame([(15,), (0,), (-10,)], "n int").select(signed(F.col("n"))).collect()] == ["+15", "+0", "-10"]
