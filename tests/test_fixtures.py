"""Adversary files, the dirty twin, folders of files, damaged files: literal expectations, none computed by the plans."""

import csv
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tamiz import cli
from tamiz.operators.compare import differences
from tamiz.operators.rules import optout_sets
from tamiz.plans.config import CANONICAL, PlanConfig
from tamiz.plans.pipeline import AUDIT, COMMERCIAL, audit_columns, build, ranked
from tamiz.sources.delimited import read_plain
from tamiz.sources.folder import numbered, read_folder
from tamiz.sources.gate import RejectedFile, read_leads, read_optout
from tamiz.sources.sinks import write_csv, write_partitioned_csv

CUTOFF = "2026-07-28"
WEIGHTS = (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)


def valid_id(prefix, number):
    """An id with its check digit; where the rule has none for a number, the next number is taken (TL1)."""
    while True:
        base = f"{prefix}{number:08d}"
        rest = sum(int(d) * w for d, w in zip(base, WEIGHTS)) % 11
        if rest != 1:
            return f"{prefix}-{number:08d}-{(11 - rest) % 11}"
        number += 1


def leads_of(spark, path):
    with open(path, encoding="utf-8-sig") as f:
        rows = [(i, *[r[c] for c in CANONICAL]) for i, r in enumerate(csv.DictReader(f), 1)]
    return spark.createDataFrame(rows, "id_fila long, " + ", ".join(f"{c} string" for c in CANONICAL))


@pytest.fixture(scope="module")
def adversary(spark, data):
    out = build(leads_of(spark, data / "dirty.csv"), "08", PlanConfig(cutoff=CUTOFF)).collect()
    assert len(out) == 48
    return {r["nombre"].strip()[:3] if r["nombre"].strip() else "T39": r for r in out if r["id_fila"] != 43}


# Published expectations of the adversary file.
PHONES = {
    "T01": ("fijo", "+541141617956"), "T02": ("celular", "+5491141617956"), "T03": ("celular", "+5491141617956"), "T04": ("celular", "+5491141617956"), "T05": ("invalido", ""), "T06": ("invalido", ""),
    "T07": ("fijo", "+541141617956"), "T08": ("invalido", ""), "T09": ("invalido", ""), "T10": ("ambiguo", "+541141617956"), "T12": ("celular", "+5491155551111"),
    "T13": ("fijo", "+541145551111"), "T44": ("invalido", ""), "T45": ("invalido", ""), "T46": ("invalido", ""),
}
DATES = {
    "T32": (109, "fria", "fecha ambigua"), "T33": (-68, "sin dato", "fecha ambigua; fecha futura"), "T34": (None, "sin dato", "fecha ilegible"), "T35": (None, "sin dato", "fecha vacia"),
    "T36": (None, "sin dato", "fecha ilegible"), "T37": (-171, "sin dato", "fecha futura"), "T38": (2705, "fria", ""),
}


def test_adversary_phones(adversary):
    assert {k: (adversary[k]["telefono_tipo"], adversary[k]["telefono_norm"]) for k in PHONES} == PHONES


def test_adversary_dates(adversary):
    assert {k: (adversary[k]["dias_antiguedad"], adversary[k]["frescura"], adversary[k]["motivo_frescura"]) for k in DATES} == DATES


def test_adversary_places(adversary):
    inside = {k: adversary[k]["en_zona"] for k in ("T15", "T16", "T17", "T18", "T19", "T20", "T21", "T22")}
    assert inside == {"T15": True, "T16": True, "T17": True, "T18": True, "T19": True, "T20": False, "T21": False, "T22": False}
    assert adversary["T21"]["motivo_descarte"] == "sin localidad" and adversary["T20"]["motivo_descarte"] == "fuera de zona de cobertura" and adversary["T39"]["motivo_descarte"] == "sin nombre"


def test_adversary_ids(adversary):
    assert {k: adversary[k]["cuil_valido"] for k in ("T23", "T24", "T25", "T47", "T48")} == {"T23": False, "T24": False, "T25": False, "T47": False, "T48": True}
    assert all(adversary[k]["cuil_dudoso"] for k in ("T03", "T14", "T33", "T37", "T44", "T47")) and not adversary["T48"]["cuil_dudoso"] and adversary["T26"]["cuil_norm"] == "20314459025" and adversary["T27"]["cuil_norm"] == "27321187450"


def test_known_gap(adversary):
    """A loser's own phone isn't handed to the winner; kept on purpose (A5)."""
    r = adversary["T31"]
    assert (r["es_duplicado"], r["duplicado_de"], r["motivo_duplicado"], r["telefono_norm"]) == (True, 28, "transitivo", "+541168442753")


def test_places(spark, data):
    out = {r["nombre"][:3]: r for r in build(leads_of(spark, data / "locality.csv"), "08", PlanConfig(cutoff=CUTOFF)).collect()}
    got = {k: (r["en_zona"], r["motivo_descarte"], r["prioridad"]) for k, r in out.items()}
    assert got == {"L01": (True, "", "alta"), "L02": (True, "", "alta"), "L03": (False, "sin localidad", "media"), "L04": (False, "fuera de zona de cobertura", "descartado"), "L05": (True, "", "alta")}
    assert "sin localidad +0" in out["L03"]["motivo"] and "fuera de zona" not in out["L03"]["motivo"] and "fuera de zona +0 → descarte" in out["L04"]["motivo"]


def test_semicolon(spark, data):
    leads, p = read_leads(spark, str(data / "semicolon.csv"))
    assert (p.separator, p.rows, p.header_line) == ("punto y coma", 5, 1)
    out = {r["nombre"][:3]: r for r in build(leads, "08", PlanConfig(cutoff=CUTOFF)).collect()}
    with open(data / "semicolon.csv", encoding="utf-8-sig") as f:
        assert all(out[r["nombre"][:3]][c] == r[c] for r in csv.DictReader(f, delimiter=";") for c in CANONICAL)
    assert [out[k]["en_zona"] for k in sorted(out)] == [True, True, True, False, False] and all(r["telefono_norm"].startswith("+54") for r in out.values())


def test_shifted_values(spark, data):
    leads, p = read_leads(spark, str(data / "shifted_header.csv"), {"Documento": "cuil"})
    out = {r["nombre"][:3]: r for r in build(leads, "14", PlanConfig(cutoff=CUTOFF)).collect()}
    assert (out["T55"]["origen"], out["T55"]["fecha_carga"], out["T55"]["extra_Observaciones"], out["T55"]["localidad"]) == ("", "", "", "Ituzaingó")
    assert out["T50"]["extra_Observaciones"] == "llamar después de las 18, dijo que sí" and not out["T57"]["cuil_valido"]
    assert sorted(dict(p.origins)) == ["(vacio)", "Base propia", "Evento", "Meta", "Referido", "Web"]
    # The optional tail of the audit: extras and the opt-out's way, sorted.
    lists = spark.createDataFrame([("011-0000", "x")], "telefono string, cuil string")
    tail = audit_columns(build(leads, "14", PlanConfig(cutoff=CUTOFF), optout_sets(lists)[:2]))[26:]
    assert tail == ["extra_Observaciones", "optout_via"]


def dirty_twin(clean, path):
    """The clean file as a client would send it: other titles, semicolons, Latin-1, CRLF, two lines above (TL2)."""
    titles = {"nombre": "Nombre y Apellido", "cuil": "Documento", "telefono": "Celular", "localidad": "Zona", "origen": "Origen del Contacto", "fecha_carga": "Fecha de Alta"}
    with open(clean, encoding="utf-8-sig") as f:
        rows = list(csv.DictReader(f))
    assert not any(ch in v for r in rows for v in r.values() for ch in ';"\n')
    lines = ["Listado exportado del sistema del cliente", "Exportación: 28/07/2026", ";".join(titles[c] for c in CANONICAL), *[";".join(r[c] for c in CANONICAL) for r in rows]]
    path.write_bytes(("\r\n".join(lines) + "\r\n").encode("latin-1"))
    return {v: k for k, v in titles.items()}


def test_twin(data, tmp_path, spark):
    """A dirty file and its clean twin end byte for byte the same, with the published numbers."""
    mapping, segment, lists = tmp_path / "map.json", tmp_path / "segment.json", tmp_path / "baja.csv"
    mapping.write_text(json.dumps(dirty_twin(data / "clean_twin.csv", tmp_path / "sucio.csv")))
    segment.write_text('{"etiquetar": true, "descartar": "juridica"}')
    lists.write_text("Celular,CUIT,Observaciones\n11 4242-4242,,pidió baja\n,20-99999999-1,\n", encoding="utf-8")
    common = ["--salida-dir", str(tmp_path), "--fecha-corte", CUTOFF, "--segmentacion", str(segment), "--baja", str(lists)]
    assert cli.main([str(tmp_path / "sucio.csv"), "--mapeo", str(mapping), *common]) == 0
    assert cli.main([str(data / "clean_twin.csv"), *common]) == 0
    for kind, end in (("comercial", "csv"), ("auditoria", "csv"), ("reporte", "md")):
        assert (tmp_path / f"{kind}_sucio.{end}").read_bytes() == (tmp_path / f"{kind}_clean_twin.{end}").read_bytes()
    with open(tmp_path / "auditoria_sucio.csv", encoding="utf-8-sig") as f:
        rows = list(csv.DictReader(f))
    of = lambda p: sum(r["prioridad"] == p for r in rows)
    assert (len(rows), of("alta"), of("media"), of("descartado")) == (25, 16, 1, 8)
    reasons = [sum(f"{t}" in r["motivo"] and "→ descarte" in r["motivo"] for r in rows) for t in ("sin teléfono", "teléfono de relleno", "duplicado", "fuera de zona", "segmento no buscado", "opt-out")]
    assert reasons == [2, 1, 2, 1, 1, 1] and "| 4 minutos | 0.5 |" in (tmp_path / "reporte_sucio.md").read_text(encoding="utf-8")
    assert cli.main([str(tmp_path / "sucio.csv"), *common]) == 1  # without the map two titles mean nothing


def test_partitioned(data, tmp_path, spark):
    """The folder of parts is the single file, cut."""
    common = [str(data / "canonical.csv"), "--fecha-corte", CUTOFF, "--fase", "08", "--salida-dir"]
    assert cli.main([*common, str(tmp_path / "a")]) == 0 and cli.main([*common, str(tmp_path / "b"), "--particionado"]) == 0
    for kind in ("comercial", "auditoria"):
        text = "".join(f.read_text(encoding="utf-8") for d in ("encabezado", "filas") for f in sorted((tmp_path / "b" / f"{kind}_canonical" / d).glob("part-*")))
        assert ("\ufeff" + text).encode() == (tmp_path / "a" / f"{kind}_canonical.csv").read_bytes()


def book(path, rows):
    cell = lambda at, v: f'<c r="{at}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{at}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>'
    shared = {}
    body = "".join(f'<row r="{i}">' + "".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(r) if v != "") + "</row>" for i, r in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t xml:space=\"preserve\">{s}</t></si>" for s in shared) + "</sst>")


def test_plain(spark, data, tmp_path):
    """The plain scan leads to the published bytes as well."""
    done = build(read_plain(spark, str(data / "canonical.csv")), "08", PlanConfig(cutoff=CUTOFF))
    # Fixed value: published digest of the audit table.
    assert write_csv(ranked(done), list(AUDIT), str(tmp_path / "a.csv")) == 200
    assert hashlib.sha256((tmp_path / "a.csv").read_bytes()).hexdigest() == "ae6fcc5f146d6ec59395b3fb09a5bbdfcd764303e762a287dfe6a44623fd9cd2"
    (tmp_path / "q.csv").write_text('\ufeffa,b\n" x ","1 ""q""\n2"\n,\n', encoding="utf-8")
    assert [tuple(r) for r in read_plain(spark, str(tmp_path / "q.csv")).orderBy("id_fila").collect()] == [(" x ", '1 "q"\n2', 1), ("", "", 2)]


def test_optout_formats(spark, data, tmp_path):
    """The same list as text and as a spreadsheet with shared strings gives the same bytes."""
    with open(data / "optout_list.csv", encoding="utf-8-sig") as f:
        book(tmp_path / "baja.xlsx", list(csv.reader(f)))
    out = []
    for source in (data / "optout_list.csv", tmp_path / "baja.xlsx"):
        done = build(leads_of(spark, data / "optout_leads.csv"), "14", PlanConfig(cutoff=CUTOFF), optout_sets(read_optout(spark, str(source)))[:2])
        write_csv(ranked(done), audit_columns(done), str(tmp_path / "x.csv"))
        out.append((tmp_path / "x.csv").read_bytes())
    assert out[0] == out[1] and b"optout_via" in out[0]


def test_optout_rejections(spark, tmp_path):
    for text in ("nombre,mail\na,b\nc,d\n", "Celular,Tel,CUIT\n1,2,3\n4,5,6\n", ""):
        (tmp_path / "l.csv").write_text(text)
        with pytest.raises(RejectedFile):
            read_optout(spark, str(tmp_path / "l.csv"))


def test_features_off(spark, data, tmp_path):
    """What is off leaves no trace in the bytes: plans 08 and 14 without options write the same."""
    out = []
    for plan, sets in (("08", None), ("14", None), ("12", None)):
        done = build(leads_of(spark, data / "canonical.csv"), plan, PlanConfig(cutoff=CUTOFF), sets)
        assert audit_columns(done) == list(AUDIT)
        for columns in (COMMERCIAL, AUDIT):
            write_csv(ranked(done), list(columns), str(tmp_path / "x.csv"))
            out.append((tmp_path / "x.csv").read_bytes())
    assert out[0] == out[2] == out[4] and out[1] == out[3] == out[5]


@pytest.mark.parametrize("day,want", [("2026-07-29", {"alta": 34, "media": 44, "baja": 68, "fria": 54}), ("2026-09-30", {"baja": 43, "fria": 157})])
def test_cutoffs(spark, data, day, want):
    done = build(leads_of(spark, data / "canonical.csv"), "05", PlanConfig(cutoff=day))
    assert dict(done.groupBy("frescura").count().collect()) == want


def test_damaged_books(spark, tmp_path):
    whole = io.BytesIO()
    book(whole, [list(CANONICAL), ["Ana", "", "1145551111", "Haedo", "x", "2026-01-01"]])
    bad = {"old.xls": b"\xd0\xcf\x11\xe0" + b"x" * 600, "cut.xlsx": whole.getvalue()[:-80], "text.xlsx": b"nombre,cuil\n", "empty.xlsx": b""}
    for name, content in bad.items():
        (tmp_path / name).write_bytes(content)
        seen = []
        with pytest.raises(RejectedFile):
            read_leads(spark, str(tmp_path / name), on_profile=seen.append)
        assert seen[0].state == "NO ENTRA" and seen[0].size == len(content)
    with zipfile.ZipFile(tmp_path / "none.xlsx", "w") as z:
        z.writestr("a.txt", "x")
    with pytest.raises(RejectedFile):
        read_leads(spark, str(tmp_path / "none.xlsx"))


def test_mostly_blank(spark, tmp_path):
    f = tmp_path / "blank.csv"
    f.write_text(",".join([*CANONICAL, "nota"]) + "\n" + ",,,,,,x\n" * 3 + "Ana,,,,,,\n" * 2)
    with pytest.raises(RejectedFile):
        read_leads(spark, str(f))


def test_folder(spark, data, tmp_path):
    """Files with different separators, encodings, header lines and titles through one call; the bad one doesn't stop the others."""
    d = tmp_path / "lots"
    d.mkdir()
    for name in ("semicolon.csv", "shifted_header.csv", "prose.txt", "canonical.csv"):
        (d / name).write_bytes((data / name).read_bytes())
    (d / "latin.csv").write_bytes("nombre\tcuil\ttelefono\tlocalidad\torigen\tfecha_carga\nPeña\t\t1145551111\tMorón\tx\t2026-01-01\n".encode("latin-1"))
    (d / "long.csv").write_text("a,b\n1,2\n" + ",".join(CANONICAL) + "\n" + "x,,,,,,extra\n" + "y,,,,,\n" * 3)
    (d / "_SUCCESS").write_text("")
    leads, verdicts = read_folder(spark, str(d), {"Documento": "cuil"})
    v = {r["archivo"]: r for r in verdicts.collect()}
    assert {k: r["estado"] for k, r in v.items()} == {"semicolon.csv": "ENTRA", "shifted_header.csv": "ENTRA", "prose.txt": "NO ENTRA", "canonical.csv": "ENTRA", "latin.csv": "ENTRA", "long.csv": "NO ENTRA"}
    s = v["shifted_header.csv"]
    assert (s["linea_encabezado"], s["filas"], s["en_blanco"], s["cortas"]) == (4, 7, 1, 1) and v["latin.csv"]["codificacion"] == "latin-1"
    assert dict(leads.groupBy("archivo").count().collect()) == {"semicolon.csv": 5, "shifted_header.csv": 7, "canonical.csv": 200, "latin.csv": 1}
    # Each file alone through the gate gives the same contacts.
    for name in ("semicolon.csv", "shifted_header.csv", "latin.csv"):
        alone, _ = read_leads(spark, str(d / name), {"Documento": "cuil"})
        got = [tuple(r) for r in leads.where(F.col("archivo") == name).orderBy("registro").select(*CANONICAL).collect()]
        assert got == [tuple(r) for r in alone.orderBy("id_fila").select(*CANONICAL).collect()]
    assert leads.where("extras['Observaciones'] like 'llamar%'").count() == 1
    done = numbered(leads)
    assert sorted(r[0] for r in done.select("id_fila").collect()) == list(range(1, 214)) and build(done, "03").count() == 213
    empty = tmp_path / "empty"
    empty.mkdir()
    assert read_folder(spark, str(empty))[0].count() == 0
    uri, _ = read_folder(spark, f"file://{d}/semicolon.csv")
    assert uri.count() == 5 and read_folder(spark, f"file://{d}", {"Documento": "cuil"})[0].count() == 213
    assert cli.main([str(d), "--salida-dir", str(tmp_path / "out"), "--fecha-corte", CUTOFF, "--particionado"]) == 0


def test_differences(spark):
    a = spark.createDataFrame([(1, "x", 5, "q"), (2, "y", None, "q"), (3, "z", 7, "q")], "id_fila long, t string, n int, old string")
    b = spark.createDataFrame([(1, "x", 5, "q"), (2, "", 4, "q"), (4, "z", 7, "q")], "id_fila long, t string, n int, new string")
    got = {tuple(r) for r in differences(a, b).collect()}
    assert got == {(2, "t", "y", ""), (2, "n", None, "4"), (3, "(fila)", "falta", None), (4, "(fila)", None, "sobra"), (None, "old", "falta", None), (None, "new", None, "sobra")}
    assert differences(a, a).count() == 0 and differences(a.limit(0), a.limit(0)).count() == 0


def test_valid_ids(spark):
    from tamiz.functions.taxid import taxid_valid

    ids = [valid_id(p, n) for p in ("20", "27", "30") for n in range(30110010, 30110060)]
    t = spark.createDataFrame([(i,) for i in ids], "c string")
    assert t.where(taxid_valid(F.col("c"))).count() == len(ids)


def test_partition_sink(spark, tmp_path):
    df = spark.createDataFrame([(i, f"a,{i}") for i in range(20)], "i int, t string").orderBy(F.desc("i"))
    write_partitioned_csv(df, ["i", "t"], str(tmp_path / "o"))
    lines = [x for f in sorted((tmp_path / "o" / "filas").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == [f'{i},"a,{i}"' for i in range(19, -1, -1)]
