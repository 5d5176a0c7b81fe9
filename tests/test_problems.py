"""Record loading, timestamps, profile: literal cases, edges, brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tamiz.operators import load_records as L
from tamiz.operators import profile as P
from tamiz.operators import timestamps as T

LOTS = "archivo_id int, separador string, n_columnas int, linea_encabezado int, col_telefono int, col_fecha int, zona_horaria string, orden_fecha string"
ROWS = "registro_id long, archivo_id int, linea int, c0 string, motivo string"


def test_judge():
    q = lambda r: L.judge(r, ",", 3)[0]
    assert [q(x) for x in ("a,b,c", '"a,1","b ""x""",c', 'x"y,b,c', "a,b", "a,b,c,d", '"a,b,c', '"a"x,b,c', ",,,,", "", '"",,', 'a,b,"')] == [
        None, None, None, L.COLUMNS, L.COLUMNS, L.QUOTES, L.QUOTES, None, None, None, L.QUOTES]


def test_blocks_equal_strict():
    """Whatever the block, bisection gives what the strict reader gives."""
    rnd = random.Random(4)
    alphabet = ["a", "b", ",", '"', '""', "\n", "\r", " ", ",", "é", ';']
    for size in (1, 2, 7, 64):
        for _ in range(60):
            block = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(size)]
            block += ["x,y,z"] * rnd.randint(0, 5)
            out = [None] * len(block)
            L.parse_block(block, ",", 3, out, list(range(len(block))))
            assert out == [L.judge(r, ",", 3) for r in block] or [(a, b) for a, b in out] == [L.judge(r, ",", 3) for r in block]


def test_load_records(spark):
    lots = spark.createDataFrame([(1, ",", 3, 1, 0, 1, "UTC", "dmy"), (2, ";", 2, 0, 0, 1, "UTC", "dmy")], LOTS).withColumn("motivo", F.lit("choca"))
    rows = [
        (1, 1, 1, "tel,fecha,x", "e"), (2, 1, 2, "1145551111,2026-01-01,ok\r", "e"), (3, 1, 3, "abc,2026-01-01,ok", "e"), (4, 1, 4, ",30/02/2026,ok", "e"), (5, 1, 5, None, "e"),
        (6, 1, 6, " , , , ,", "e"), (7, 1, 7, "1145551111,2026-01-01", "e"), (8, 1, 8, '"114', "e"), (9, 2, 1, "1145551111;01/02/2026", "e"), (10, 3, 1, "x", "e"), (10, 3, 1, "x", "e"),
        (11, 1, 9, "1145551111,,línea\ncortada", "e"), (12, 1, 10, "1145551111,," + "z" * 100_000, "e"), (13, None, 1, "x", "e"),
    ]
    got = L.load_records(spark.createDataFrame(rows, ROWS), lots, block=4).select("registro_id", "motivo").collect()
    assert sorted((r[0], r[1] or "") for r in got) == sorted(
        [(2, ""), (3, "valor"), (4, "valor"), (5, ""), (6, ""), (7, "columnas"), (8, "comillas"), (9, ""), (10, "sin lote"), (10, "sin lote"), (11, ""), (12, ""), (13, "sin lote")]
    )
    assert L.load_records(spark.createDataFrame([], ROWS), lots).count() == 0


MOMENTS = [
    ("2026-03-05", "2026-03-05"), (" 5/3/26 ", "2026-03-05"), ("05-03-2026", "2026-03-05"), ("20260305", "2026-03-05"), ("5 de marzo de 2026", "2026-03-05"), ("05-mar-26", "2026-03-05"),
    ("Mar 5, 2026", "2026-03-05"), ("2026/03/05", "2026-03-05"), ("46086", "2026-03-05"), ("46086.5", "2026-03-05T11:00:00.000000Z"), ("1772668800", "2026-03-05T00:00:00.000000Z"),
    ("1772668800123", "2026-03-05T00:00:00.123000Z"), ("1772668800123456", "2026-03-05T00:00:00.123456Z"), ("2026-03-05T10:00:00Z", "2026-03-05T10:00:00.000000Z"),
    ("2026-03-05 10:00", "2026-03-05T09:00:00.000000Z"), ("2026-03-05 10:00:00,123456789", "2026-03-05T09:00:00.123456Z"), ("2026-03-05T10:00:00 UTC-3", "2026-03-05T13:00:00.000000Z"),
    ("2026-03-05T10:00:00-0330", "2026-03-05T13:30:00.000000Z"), ("05/03/2026 12:05 a. m.", "2026-03-04T23:05:00.000000Z"), ("05/03/2026 12:05 PM", "2026-03-05T11:05:00.000000Z"),
    ("05/03/2026 13:05 pm", "ilegible"), ("5 de marzo de 2026, 10:00 hs ART", "2026-03-05T13:00:00.000000Z"), ("Thu, 05 Mar 2026 10:00:00 +0100", "2026-03-05T09:00:00.000000Z"),
    ("2026-03-05T10:00:00 America/Santiago", "2026-03-05T13:00:00.000000Z"), ("2026-03-05T10:00:00[America/New_York]", "2026-03-05T15:00:00.000000Z"), ("2026-03-05T10:00:00 Marte/Base", "ilegible"),
    ("2026-03-29 02:30", "inexistente"), ("2025-10-26 02:30", "ambigua"), ("2025-10-26 02:30 CET", "2025-10-26T01:30:00.000000Z"), ("2025-10-26 02:30+02:00", "2025-10-26T00:30:00.000000Z"),
    ("2025-10-26 01:59:59", "2025-10-25T23:59:59.000000Z"), ("2025-10-26 03:00", "2025-10-26T02:00:00.000000Z"), ("2026-02-30", "ilegible"), ("25:10", "ilegible"), ("2026-01-15T25:10:00", "ilegible"),
    ("ayer", "ilegible"), ("123456", "ilegible"), ("x" * 10000, "ilegible"), ("", None), ("  ", None), (None, None), ("1969-12-31T23:59:59.5Z", "1969-12-31T23:59:59.500000Z"),
]


def test_moments(spark):
    rows = [(i, "Europe/Madrid", "dmy", t, "choca") for i, (t, _) in enumerate(MOMENTS)]
    df = spark.createDataFrame(rows, "i int, z string, o string, t string, resultado string")
    got = {r["i"]: r["resultado"] for r in T.normalise_moments(df, "t", "z", "o").collect()}
    assert {MOMENTS[i][0]: v for i, v in got.items()} == dict(MOMENTS)


def test_moments_zones(spark):
    df = spark.createDataFrame([(1, None, None, "2026-03-05 10:00"), (2, "Nada/Aqui", "mdy", "2026-03-05 10:00"), (3, None, "mdy", "03/05/2026"), (4, "Australia/Lord_Howe", "dmy", "2026-04-05 01:45"), (5, "UTC", "dmy", "2026-03-05 10:00"), (6, "+03:00", "dmy", "2026-03-05 10:00")], "i int, z string, o string, t string")
    got = {r["i"]: r["resultado"] for r in T.normalise_moments(df, "t", "z", "o").collect()}
    assert got == {1: "ilegible", 2: "ilegible", 3: "2026-03-05", 4: "ambigua", 5: "2026-03-05T10:00:00.000000Z", 6: "ilegible"}
    assert T.normalise_moments(df.limit(0), "t", "z", "o").count() == 0


def test_final_form(spark):
    values = ["2026-03-05", " 2026-03-05", "2026-02-30", "2026-03-05T10:00:00.000000Z", "2026-03-05T10:00:00Z", "0050-01-01", "0100-01-01", "2026-03-05T24:00:00.000000Z", "2026-03-05T10:00:60.000000Z", None]
    df = spark.createDataFrame([(i, v, "UTC", "dmy") for i, v in enumerate(values)], "i int, t string, z string, o string")
    out = T.normalise_moments(df.withColumn("final", T.is_final(F.col("t"))), "t", "z", "o").orderBy("i").collect()
    assert [r["final"] for r in out] == [True, False, False, True, False, False, True, False, False, False]
    # What counts as final is exactly what the cascade gives back unchanged.
    assert [r["final"] for r in out] == [r["t"] is not None and r["t"] == r["resultado"] for r in out]


def test_profile(spark):
    rows = [(1, 1, "a", 5), (2, 1, "a", 7), (3, 1, "", None), (4, 2, None, 1), (5, 2, "zz", 3), (6, 2, "b", 5), (7, None, "a", 9)]
    t = spark.createDataFrame(rows, "id long, carga long, valor string, n int")
    counts = P.value_counts(t, "carga", ["valor", "n"])
    prof = {(r["carga"], r["columna"]): r for r in P.column_profile(counts, {"valor": "[a-z]"}).collect()}
    one = prof[(1, "valor")]
    assert (one["filas"], one["nulos"], one["vacios"], one["distintos"], one["violaciones"]) == (3, 0, 1, 2, 0) and prof[(2, "valor")]["violaciones"] == 1 and prof[(2, "valor")]["nulos"] == 1
    halves = [P.value_counts(t.where(f"id % 2 = {k}"), "carga", ["valor", "n"]) for k in (0, 1)]
    assert sorted(map(str, P.merge_counts(*halves).collect())) == sorted(map(str, counts.collect()))
    whole, merged = P.power_sums(counts), P.merge_power_sums(*map(P.power_sums, halves))
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect()))
    s = whole.where("carga = 1").first()
    assert [int(s[f"s{i}"]) for i in range(5)] == [2, 12, 74, 468, 3026]
    d = {r["carga"]: r for r in P.standardised_differences(whole).collect()}
    assert d[1]["media"] == 6.0 and d[1]["media_resto"] == pytest.approx(4.5)
    assert P.column_profile(P.value_counts(t.limit(0), "carga", ["valor"])).count() == 0


def test_profile_ranges(spark):
    """Numbers range as numbers, text as text, whether by load or over all, from counts read at once or merged."""
    rows = [(1, -199, "9.5", "9", "-199"), (1, 9, "-10.25", "10", "9"), (1, 105, "100", "", "105"), (2, 95, None, None, None), (2, -10, None, "b", "z"), (2, -1, None, "a", "")]
    t = spark.createDataFrame(rows, "carga long, n int, d string, s string, u string").selectExpr("carga", "n", "cast(d as decimal(9,2)) d", "s", "u", "n * 1000000000000L m")
    columns = ["n", "d", "s", "u", "m"]
    counts = P.merge_counts(*[P.value_counts(t.where(f"n % 2 = {k}"), "carga", columns) for k in (0, 1, -1)])
    got = {(r["carga"], r["columna"]): (r["minimo"], r["maximo"]) for r in P.column_profile(counts, schema=t.schema).collect()}
    assert got == {
        (1, "n"): ("-199", "105"), (1, "d"): ("-10.25", "100.00"), (1, "s"): ("", "9"), (1, "u"): ("-199", "9"), (1, "m"): ("-199000000000000", "105000000000000"),
        (2, "n"): ("-10", "95"), (2, "d"): (None, None), (2, "s"): ("a", "b"), (2, "u"): ("", "z"), (2, "m"): ("-10000000000000", "95000000000000"),
    }
    whole = {r["columna"]: (r["minimo"], r["maximo"]) for r in P.column_profile(counts, by_load=False, schema=t.schema).collect()}
    assert whole["n"] == ("-199", "105") and whole["u"] == ("", "z")


def test_table_profile_ranges(spark, tmp_path):
    """The registered query takes the ranges by the table's own types."""
    rows = [(i, 1, n, n, "celular") for i, n in enumerate((-199, 9, 105, 95, None))]
    spark.createDataFrame(rows, "id_fila long, carga_id long, puntaje int, duplicado_de long, telefono_tipo string").write.parquet(f"{tmp_path}/salida_adv1.parquet")
    got = {r["columna"]: (r["minimo"], r["maximo"]) for r in P.table_profile(spark, str(tmp_path)).collect()}
    assert got["puntaje"] == got["duplicado_de"] == ("-199", "105") and got["id_fila"] == ("0", "4") and got["telefono_tipo"] == ("celular", "celular")


def test_share_shifts_brute(spark):
    rnd = random.Random(2)
    rows = [(k, rnd.choices(["a", "b", "", None, "c"], [8, 3 if k != 3 else 30, 1, 1, 0 if k else 6])[0]) for k in range(6) for _ in range(80)]
    t = spark.createDataFrame(rows, "carga long, v string")
    got = {(r["carga"], r["valor"]) for r in P.share_shifts(P.value_counts(t, "carga", ["v"]), 0.21).collect()}
    share = {k: {v: sum((x or "") == v for c, x in rows if c == k) / 80 for v in ("a", "b", "", "c")} for k in range(6)}
    want = set()
    for v in ("a", "b", "", "c"):
        s = sorted(share[k][v] for k in share)
        med = (s[2] + s[3]) / 2
        want |= {(k, v) for k in share if round(abs(share[k][v] - med), 12) > 0.21}
    assert got == want and want


def test_violations(spark):
    t = spark.createDataFrame([(1, 1, "TRUE"), (2, 1, "true"), (3, 1, ""), (4, 2, None), (5, 2, "TRUE "), (5, 2, "TRUE "), (6, None, "x"), (7, 2, "FALSE\n")], "id long, carga long, b string")
    bad = P.violations(P.value_counts(t, "carga", ["b"]), {"b": "TRUE|FALSE"})
    assert {(r["valor"], r["n"]) for r in bad.collect()} == {("true", 1), ("TRUE ", 2), ("x", 1), ("FALSE\n", 1)}
    for most in (1_000_000, 1):
        assert sorted(r["clave"] for r in P.violating_rows(t, "id", bad, ["b"], most).collect()) == [2, 5, 5, 6, 7]
    assert P.violating_rows(t.limit(0), "id", bad, ["b"]).count() == 0


def test_wide_profile(spark):
    """Columns profiled directly come out as those profiled from their counts."""
    rows = [(i, i % 3 if i % 7 else None, ["a", "", None, "bb", "c\n"][i % 5], float(i % 11) if i % 4 else None, i * 10**15 - 99) for i in range(200)]
    t = spark.createDataFrame(rows, "id int, carga int, s string, d double, m long")
    patterns = {"s": "[a-z]"}
    get = lambda df: sorted(map(str, df.select("carga", "columna", "filas", "nulos", "vacios", "distintos", "minimo", "maximo", "violaciones").collect()))
    counted = get(P.column_profile(P.value_counts(t, "carga", ["id", "s", "d", "m"]), patterns, schema=t.schema))
    assert get(P.wide_profile(t, "carga", ["id", "s", "d", "m"], patterns)) == counted
    for narrow in (0, 0.1, 1):
        assert get(P.full_profile(t, "carga", patterns, narrow)) == counted
    assert P.full_profile(t.limit(0), "carga").count() == 0


def test_share_differences(spark):
    """The standardised difference of a share is that of its indicator."""
    rows = [(k, "a" if i < 10 * (k + 1) else "b") for k in range(4) for i in range(50)]
    t = spark.createDataFrame(rows, "carga long, v string")
    got = {(r["carga"], r["valor"]): r for r in P.share_shifts(P.value_counts(t, "carga", ["v"]), 0.21).collect()}
    ones = t.selectExpr("carga", "if(v = 'a', 1, 0) x")
    plain = {r["carga"]: r for r in P.standardised_differences(P.power_sums(P.value_counts(ones, "carga", ["x"]))).collect()}
    assert set(got) == {(0, "a"), (0, "b"), (3, "a"), (3, "b")}
    for k in (0, 3):
        assert got[(k, "a")]["parte"] == pytest.approx(plain[k]["media"]) and got[(k, "a")]["diferencia"] == pytest.approx(plain[k]["diferencia"])
