"""The lead plans on literal files: published digests, counts and laws."""

import csv
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tamiz import cli
from tamiz.operators import dedup, mutations, report, rules
from tamiz.plans.config import CANONICAL, ConfigError, Filler, OptOut, PlanConfig, Segment, check_mapping
from tamiz.plans.pipeline import AUDIT, COMMERCIAL, build, ranked
from tamiz.sources.delimited import Unreadable, count_fields, records, sniff_separator
from tamiz.sources.gate import RejectedFile, read_leads, read_optout, resolve_headers
from tamiz.sources.sinks import write_csv

# Published SHA-256 of the two outputs for the canonical file at cutoff 2026-07-28.
COMMERCIAL_SHA = "9a6884603f9128c29a7503cb25b8417ceb233b58bdd89e9053bf4f486a61dcb4"
AUDIT_SHA = "ae6fcc5f146d6ec59395b3fb09a5bbdfcd764303e762a287dfe6a44623fd9cd2"
SCHEMA = "id_fila long, " + ", ".join(f"{c} string" for c in CANONICAL)


def rows_of(path):
    with open(path, encoding="utf-8-sig") as f:
        return [(i, *[r[c] for c in CANONICAL]) for i, r in enumerate(csv.DictReader(f), 1)]


@pytest.fixture(scope="module")
def canonical(spark, data):
    df = spark.createDataFrame(rows_of(data / "canonical.csv"), SCHEMA)
    return build(df, "08", PlanConfig(cutoff="2026-07-28")).persist()


def test_published_bytes(canonical, tmp_path):
    r = ranked(canonical)
    for columns, sha in ((COMMERCIAL, COMMERCIAL_SHA), (AUDIT, AUDIT_SHA)):
        p = tmp_path / "out.csv"
        assert write_csv(r, list(columns), str(p)) == 200
        assert hashlib.sha256(p.read_bytes()).hexdigest() == sha


def test_published_numbers(canonical):
    n = {k: dict(canonical.groupBy(k).count().collect()) for k in ("telefono_tipo", "frescura", "prioridad", "cuil_dudoso")}
    first = dict(build(canonical.select("id_fila", *CANONICAL), "01").groupBy("telefono_tipo").count().collect())
    assert first == {"celular": 42, "fijo": 45, "ambiguo": 31, "invalido": 82} and sum(n["telefono_tipo"].values()) == 200
    assert (n["frescura"], n["prioridad"]) == ({"alta": 39, "media": 42, "baja": 65, "fria": 54}, {"alta": 48, "media": 38, "descartado": 114})
    assert n["cuil_dudoso"][True] == 19
    m = report.metrics(canonical).first().asDict()
    assert (m["sin_telefono"], m["duplicado"], m["fuera_zona"], m["puntaje_bajo"]) == (82, 14, 39, 3)
    d = report.derived(m)
    assert (d["unicos"], d["llamables"], d["horas"], d["horas_bajo"], d["horas_alto"]) == (186, 86, "7.6", "3.8", "9.5")
    assert "| Alta | 48 | 24.0% |" in report.render(m, "2026-07-28")


def test_motive_adds_up(canonical):
    total = F.aggregate(F.transform(F.regexp_extract_all("motivo", F.lit(r"([+-][0-9]+)"), F.lit(1)), lambda x: x.cast("int")), F.lit(0), lambda a, x: a + x)
    assert canonical.where(total != F.col("puntaje")).count() == 0


def test_no_chains_and_marks(canonical):
    losers = canonical.where("es_duplicado").select("duplicado_de", "motivo_duplicado")
    winners = canonical.where("not es_duplicado").select(F.col("id_fila").alias("duplicado_de"))
    assert losers.join(winners, "duplicado_de", "left_anti").count() == 0 and losers.where("motivo_duplicado = ''").count() == 0
    assert canonical.where("not es_duplicado and (duplicado_de is not null or motivo_duplicado <> '')").count() == 0
    assert canonical.where("marcado <> (motivo_descarte <> '')").count() == 0


def test_dedup_cases(spark):
    rows = [
        (1, "a", "20-1", "1145551111", "x", "o", "2026-01-01"), (2, "b", "20-1", "sin dato", "x", "o", "2026-03-01"), (3, "c", "", "549 11 4555 1111", "x", "o", "2026-02-01"),
        (4, "d", "", "sin dato", "", "", ""), (5, None, None, None, None, None, None),
    ]
    out = {r["id_fila"]: r for r in build(spark.createDataFrame(rows, SCHEMA), "03").collect()}
    assert (out[1]["duplicado_de"], out[1]["motivo_duplicado"]) == (2, "cuil")
    assert (out[3]["duplicado_de"], out[3]["motivo_duplicado"]) == (2, "transitivo")
    assert not out[2]["es_duplicado"] and not out[4]["es_duplicado"] and not out[5]["es_duplicado"] and len(out) == 5


def test_empty_table(spark):
    done = build(spark.createDataFrame([], SCHEMA), "14", PlanConfig(cutoff="2026-07-28", segment=Segment(True, None)))
    assert done.count() == 0 and report.metrics(done).first()["total"] == 0


def test_filler_segment_optout(spark, data):
    filler = build(spark.createDataFrame(rows_of(data / "filler.csv"), SCHEMA), "08", PlanConfig(cutoff="2026-07-28"))
    assert filler.where("motivo like '%teléfono de relleno%'").count() == 2 and filler.where("motivo like '%nombre de relleno%'").count() == 2
    leads = spark.createDataFrame(rows_of(data / "segment.csv"), SCHEMA)
    off, on = build(leads, "12", PlanConfig(cutoff="2026-07-28")), build(leads, "12", PlanConfig(cutoff="2026-07-28", segment=Segment(True, "juridica")))
    assert "tipo_persona" not in off.columns and on.where("tipo_persona = 'juridica' and motivo not like '%segmento no buscado%'").count() == 0
    sets = rules.optout_sets(read_optout(spark, str(data / "optout_list.csv")))
    hit = build(spark.createDataFrame(rows_of(data / "optout_leads.csv"), SCHEMA), "14", PlanConfig(cutoff="2026-07-28"), sets[:2])
    assert dict(hit.where("optout_via is not null").groupBy("optout_via").count().collect()) == {"telefono": 2, "cuil": 1, "ambos": 1}


def test_mutations(canonical, spark):
    r = mutations.undetected(canonical).first()
    assert (r["base"], r["mutaciones"], r["no_detectadas"]) == (181, 181 * 99, 0)


def test_config_refuses():
    for bad in (lambda: Segment(True, "desconocida"), lambda: Segment("si"), lambda: Filler(tail=3), lambda: Filler(sequences=("123",)), lambda: OptOut("baja"), lambda: check_mapping({"x": "dni"})):
        with pytest.raises(ConfigError):
            bad()
    assert check_mapping({"_c": "nada", "Tel": "telefono"}) == {"Tel": "telefono"}


def test_records():
    read = lambda t: list(records(io.StringIO(t, newline=""), ","))
    assert read('a,"b ""x"", c"\r\n1,"l1\nl2"\r\r2,x"y\n') == [["a", 'b "x", c'], ["1", "l1\nl2"], [""], ["2", 'x"y']]
    assert read('a,"open') == [["a", "open"]] and read("") == [] and read("a,b") == [["a", "b"]]
    assert count_fields('a,"b,c",d', ",") == 3
    assert sniff_separator(["a;b;c", "1;2;3", "titulo"])[0] == ";"
    for bad in ([], ["solo", "texto"], ["a,b;c", "1,2;3"]):
        with pytest.raises(Unreadable):
            sniff_separator(bad)


def test_headers():
    assert {k: v[0] for k, v in resolve_headers(["Celular", "CUIT", "x"]).items()} == {"telefono": 0, "cuil": 1}
    for bad in (["Tel", "tel"], ["Tel", "Celular"]):
        with pytest.raises(Unreadable):
            resolve_headers(bad)


def test_gate(spark, data, tmp_path):
    mapping = {"Documento": "cuil"}
    leads, p = read_leads(spark, str(data / "shifted_header.csv"), mapping)
    assert (p.header_line, len(p.skipped), p.rows, p.blank_rows, p.short_rows, p.extras) == (4, 3, 7, 1, 1, ["Observaciones"])
    assert [r[0] for r in leads.orderBy("id_fila").select("id_fila").collect()] == list(range(1, 8))
    seen = []
    with pytest.raises(RejectedFile):
        read_leads(spark, str(data / "prose.txt"), on_profile=seen.append)
    assert seen[0].state == "NO ENTRA" and "NO ENTRA" in seen[0].render()
    latin = tmp_path / "latin.csv"
    latin.write_bytes("basura\r\nnombre;cuil;telefono;localidad;origen;fecha_carga\r\nPeña;;1145551111;Morón;x;2026-01-01\r\n;;;;;\r\n".encode("latin-1"))
    leads, p = read_leads(spark, str(latin))
    assert p.encoding.startswith("Latin-1") and leads.first()["nombre"] == "Peña" and p.blank_rows == 1
    empty = tmp_path / "empty.csv"
    empty.write_text("nombre,cuil,telefono,localidad,origen,fecha_carga\n")
    with pytest.raises(RejectedFile):
        read_leads(spark, str(empty))


def lines_of(folder):
    return [x for f in sorted(folder.glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]


def test_whole_profile(spark, tmp_path):
    """Nothing of a long profile is lost: counts are of all, lists beyond the profile's lines stand whole beside it."""
    f, out = tmp_path / "long.csv", tmp_path / "ficha_long.md"
    junk = [f"nota {i},x" if i < 20 else f"nota {i}" if i % 2 else "" for i in range(1000)]
    short = [f"Ana {i},,1145551111" for i in range(300)]
    trimmed = [f"Eva {i},,1145551111,Haedo,origen {i:03},2026-01-01,," for i in range(250)]
    full = [f"Leo {i},,1145551111,Haedo,origen {i:03},2026-01-01" for i in range(700)]
    f.write_text("\n".join([*junk, ",".join(CANONICAL), *short, *trimmed, *full]) + "\n", encoding="utf-8")
    _, p = read_leads(spark, str(f), on_profile=lambda x: x.write(str(out)))
    assert (p.header_line, p.skipped_rows, p.short_rows, p.trimmed_rows, p.distinct_origins, p.rows) == (1001, 1000, 300, 250, 701, 1250)
    assert sum("campos en blanco del final" in w for w in p.warnings) == 200 and len(p.short_list) == 200 and p.warnings[0].startswith("registro 1302:")
    text = out.read_text(encoding="utf-8")
    for line in ("| Registros antes de los titulos | 1000 |", "| Registros recortados | 250 |", "| Origenes distintos | 701 |", "salteadas: 200 de 1000 aqui, completas en ficha_long_listas/salteadas"):
        assert line in text
    whole = tmp_path / "ficha_long_listas"
    assert lines_of(whole / "salteadas") == [f"registro {i + 1}: {x or '(en blanco)'}" for i, x in enumerate(junk)]
    assert lines_of(whole / "incompletas") == [f"registro {1002 + i}: 3 campos, faltan 3" for i in range(300)]
    assert lines_of(whole / "recortadas") == [f"registro {1302 + i}: se quitaron campos en blanco del final" for i in range(250)]
    assert lines_of(whole / "origenes") == ["(vacio): 300", *[f"origen {i:03}: {1 + (i < 250)}" for i in range(700)]]


def sheet(path, rows):
    cells = []
    for i, row in enumerate(rows, 1):
        cells.append(f'<row r="{i}">' + "".join(f'<c r="{chr(65 + j)}{i}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(row)) + "</row>")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + "".join(cells) + "</sheetData></worksheet>")


def test_spreadsheet(spark, tmp_path):
    p = tmp_path / "x.xlsx"
    sheet(p, [list(CANONICAL), ["Ana", "20-12345678-6", 1141617956, "Castelar", "referido", "2026-01-01"], ["Eva", 20123456786, "011-41617956", "Haedo", "", ""]])
    leads, prof = read_leads(spark, str(p))
    rows = leads.orderBy("id_fila").collect()
    assert rows[0]["telefono"] == "1141617956.0" and "telefono" in rows[0]["advertencia_entrada"] and rows[1]["cuil"] == "20123456786" and prof.rows == 2
    assert build(leads, "01").where("id_fila = 1").first()["telefono_tipo"] == "invalido"


def test_whole_notes(spark, tmp_path):
    p, out = tmp_path / "n.xlsx", tmp_path / "ficha_n.md"
    sheet(p, [list(CANONICAL), *[["Ana", "", 1141617956, "Castelar", "referido", "2026-01-01"] for _ in range(230)]])
    _, prof = read_leads(spark, str(p), on_profile=lambda x: x.write(str(out)))
    listed = lines_of(tmp_path / "ficha_n_listas" / "numericas")
    assert (prof.noted_rows, len(prof.warnings), len(listed)) == (230, 200, 230) and listed[-1].startswith("registro 231: telefono: celda numerica")
    assert "| Contactos con celdas numericas | 230 |" in out.read_text(encoding="utf-8")


def test_cli(data, tmp_path, spark):
    assert cli.main([]) == 2 and cli.main([str(tmp_path / "none.csv")]) == 2
    assert cli.main([str(data / "prose.txt"), "--salida-dir", str(tmp_path)]) == 1 and (tmp_path / "ficha_entrada_prose.md").exists() and not (tmp_path / "comercial_prose.csv").exists()
    assert cli.main([str(data / "clean_twin.csv"), "--salida-dir", str(tmp_path), "--fecha-corte", "2026-07-28"]) == 0
    assert (tmp_path / "comercial_clean_twin.csv").read_bytes().startswith(b"\xef\xbb\xbfnombre,") and (tmp_path / "reporte_clean_twin.md").exists()


def test_extra_rows(spark):
    t = spark.createDataFrame([("a",), ("a",), ("",), ("",), (None,)], "k string")
    r = dedup.extra_rows(t, ["k"]).first()
    assert (r["sobrantes"], r["con_vacios"]) == (1, 2)
