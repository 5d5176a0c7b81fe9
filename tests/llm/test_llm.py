"""Operators of the llm package: brute force, round trips, edges."""

import os
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tamiz.llm import components, encodings, leakage, mapping, survivors, tokens, truncation

VOCABULARY = tokens.default_vocabulary()
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="public tokenizer files are not here")


def union_find(edges):
    p = {}

    def find(x):
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            p[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in p}


def test_consolidate(spark):
    rnd = random.Random(3)
    ring = [(i, (i + 1) % 9) for i in range(9)]
    path = [(100 + i, 101 + i) for i in range(23)]
    star = [(200, i) for i in range(201, 230)] + [(i, i + 100) for i in range(201, 230)]
    lasso = [(400, 401), (401, 402), (402, 400), (402, 403), (403, 404)]
    noise = [(500 + rnd.randrange(40), 500 + rnd.randrange(40)) for _ in range(45)]
    edges = ring + path + star + lasso + noise + [(1, 0), (7, 7), (None, 4), (600, 601), (601, 600)]
    got = {r["id"]: r["grupo"] for r in components.consolidate(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == union_find(edges)
    assert components.consolidate(spark.createDataFrame([], "u long, v long")).count() == 0


def test_consolidate_hub(spark, monkeypatch):
    """A vertex that a third and more of all edges meet at, with chain ends, leaves and rings around it."""
    from tamiz.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    monkeypatch.setattr(skew, "HOT_SHARE", 50)
    hub = [(0, i) for i in range(1, 400)]
    ends = [(i, 1000 + i) for i in range(1, 200)] + [(1000 + i, 2000) for i in range(1, 200)]
    more = [(3000 + i, 3001 + i) for i in range(40)] + [(2000, 3000), (5000, 5001), (5001, 5002), (5002, 5000)]
    edges = hub + ends + more
    got = {r["id"]: r["grupo"] for r in components.consolidate(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == union_find(edges)


SALIDA = "id_fila long, archivo_id int, nombre string, cuil string, telefono string, localidad string, origen string, fecha_carga string, telefono_norm string, cuil_norm string, telefono_match string, duplicado_de long, valor string"


def test_survivors(spark):
    rows = [
        (1, 1, "Ana", "20-12345678-6", "x", "A", "", "2026-01-01", "", "20123456786", "", None, "e"),
        (2, 1, "Eva", "20-12345678-5", "y", None, " ", "01/02/2026", "+541145551111", "", "1145551111", 1, "e"),
        (3, 2, "Eva", "", "z", "B", "web", "ayer", "+541145551112", "", "1145551112", 2, "e"),
        (4, 2, "Leo", "", "", "", "", "", "", "", "", 99, "e"), (5, 2, "Uno", "", "", "", "", "2026-01-01", None, "", "", None, "e"),
    ]
    t = spark.createDataFrame(rows, SALIDA)
    groups = survivors.duplicate_groups(t)
    got = {(r["grupo"], r["campo"]): r["id_fila"] for r in survivors.survivors(t, groups).collect()}
    assert got == {(1, "nombre"): 2, (1, "cuil"): 1, (1, "telefono"): 2, (1, "localidad"): 1, (1, "origen"): 3, (1, "fecha_carga"): 2}
    assert survivors.survivors(t.limit(0), survivors.duplicate_groups(t.limit(0))).count() == 0


def test_survivor_ties(spark):
    rows = [(i, 1, "Ana", None, "t", "A", "o", "2026-01-01", "+541145551111", "", "", None if i == 3 else 3, "e") for i in (5, 3, 4)]
    t = spark.createDataFrame(rows, SALIDA)
    assert {r["id_fila"] for r in survivors.survivors(t, survivors.duplicate_groups(t)).collect()} == {3}


def test_value_truth(spark):
    """Three good sources and a bad one over values that are known."""
    rnd = random.Random(5)
    claims = [(o, "c", f"v{o}" if rnd.random() < (0.95 if s < 3 else 0.2) else f"w{o}{rnd.randrange(3)}", s) for o in range(150) for s in range(4)]
    p = survivors.value_truth(spark.createDataFrame(claims + [(None, "c", "x", 1), (1, "c", None, 1)], "objeto long, campo string, valor string, fuente int")).collect()
    right = sum((r["probabilidad"] > 0.5) == r["valor"].startswith("v") for r in p)
    assert right / len(p) > 0.9
    assert survivors.value_truth(spark.createDataFrame([], "objeto long, campo string, valor string, fuente int")).count() == 0
    again = survivors.value_truth(spark.createDataFrame(claims * 2, "objeto long, campo string, valor string, fuente int")).collect()
    assert sorted((r["objeto"], r["valor"], round(r["probabilidad"], 6)) for r in again) == sorted((r["objeto"], r["valor"], round(r["probabilidad"], 6)) for r in p)


def test_source_quality_settles(spark):
    claims = spark.createDataFrame([(o, "c", f"v{o}", s) for o in range(20) for s in range(3)], "objeto long, campo string, valor string, fuente int")
    patterns = survivors.claim_patterns(claims).groupBy("patron").count().withColumnRenamed("count", "n")
    rates, judged = survivors.source_quality(patterns)
    assert judged.count() == 1 and judged.first()["n"] == 20 and rates.count() == 3
    with pytest.raises(RuntimeError):
        survivors.source_quality(patterns, tolerance=-1.0, max_rounds=2)


def test_agreement(spark, tmp_path):
    rows = [(1, 1, "Ana", "20-12345678-6", "x", "A", "", "2026-01-01", "", "20123456786", "", None, "e"), (2, 1, "Eva", "", "y", None, " ", "01/02/2026", "+541145551111", "", "1145551111", 1, "e"), (3, 2, "Eva", "", "z", "B", "web", "ayer", "+541145551112", "", "1145551112", 2, "e")]
    spark.createDataFrame(rows, SALIDA).write.parquet(f"{tmp_path}/salida_adv1.parquet")
    got = {r["campo"]: r for r in survivors.agreement(spark, str(tmp_path)).collect()}
    assert (got["cuil"]["casos"], got["cuil"]["iguales"], got["cuil"]["disputados"]) == (1, 1, 0) and got["nombre"]["disputados"] == 1


def test_groups_by_keys(spark):
    rows = [(1, "a", "", None), (2, "a", "p", None), (3, "", "p", None), (4, "", "", 3), (5, "", "", None), (6, None, None, None), (7, "b", "q", 77)]
    t = spark.createDataFrame(rows, "id_fila long, cuil_norm string, telefono_match string, duplicado_de long")
    e = components.key_edges(t, "id_fila", ["cuil_norm", "telefono_match"]).unionByName(components.declared_edges(t))
    assert {r["id"]: r["grupo"] for r in components.consolidate(e).collect()} == {1: 1, 2: 1, 3: 1, 4: 1}


def test_distance():
    def plain(a, b):
        d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                x, y = a[i - 1], b[j - 1]
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (x != y and "?" not in (x, y)))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rnd = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(rnd.choice("abc?") for _ in range(rnd.randint(0, 8))) for _ in range(2))
        if "?" not in a or "?" not in b:
            assert mapping.distance(a, b) == plain(a, b)


PLACES = [(1, "Colonia Norte"), (2, "Colonia Verde"), (3, "Colonia Vieja"), (4, "Villa Ñandú"), (5, "Villa Ñandú Chico"), (6, "Orlundo"), (7, "General Paz"), (8, "General Roca"), (9, "General Soler"), (10, "Villa Elisa")]


NOISE = frozenset("loc barrio cp de".split())


@pytest.mark.parametrize("typed,want", [
    ("Villa Ñandú", 4), ("villa nandu", 4), ("VILLA ÑANDÚ CHICO", 5), ("Villa Ñandú Chiico", 5), ("Loc. Villa Ñandú (pdo. de X)", 4), ("Gral. Soler, Provincia", 9), ("Ñandú CP 1234", 4), ("GeneralRoca", 8),
    ("Villa Ã\x91andÃº", 4), ("Orlnudo", 6), ("barrio Orlundo", 6), ("Col. Berde", 2), ("xxx", 0), ("1234", 0), ("", 0), (" ", 0), ("?", 0), ("General", 0), ("z" * 5000, 0),
])
def test_places(typed, want):
    assert mapping.Matcher(PLACES, NOISE).match(typed) == want


@pytest.mark.parametrize("typed,want", [
    ("Provincia X, Villa Elisa", 10), ("- Villa Elisa", 10), ("(Villa Elisa)", 10), ("xxx (yyy; Orlnudo)", 6), ("xxx / yyy / Gral. Soler", 9), ("xxx - Orlundo", 6), ("Villa Elisa, Orlundo", 10), ("Orlundo (Villa Elisa)", 6), ("xxx, yyy", 0), ("(", 0), (", -", 0),
])
def test_later_parts(typed, want):
    assert mapping.Matcher(PLACES, NOISE).match(typed) == want


@pytest.mark.parametrize("typed,want", [("Jlao", 1), ("Jaol", 1), ("Jalo", 1), ("Olbarond", 2), ("Oblrando", 2), ("Muxe", 0), ("Nlao", 0)])
def test_swapped_names(typed, want):
    """A swap may leave no pair of letters as it was; likeness decides all the same."""
    m = mapping.Matcher([(1, "Jalo"), (2, "Oblarnod"), (3, "Pirqueta"), (4, "Villa Montero")])
    near = {i: mapping.likeness(mapping.fold(typed), mapping.fold(n)) for n, i in m.exact.items()}
    assert max(near.values()) >= mapping.LEAST or not want
    assert m.match(typed) == want


def test_noise_words(spark):
    """Words around several names are noise; a misspelt name word, a rare word and the words of names aren't."""
    typed = [f"{w} {n}" for w in ("ciudad de", "loc.") for _, n in PLACES] + ["Orlundo casa", "Vila Elisa", "Villa Nandu Chco", "xxx yyy", "General Roca"] + [f"Orlundo {i}a" for i in range(30)]
    values = spark.createDataFrame([(v,) for v in typed], "valor string")
    assert mapping.noise_words(values, PLACES) == {"ciudad", "de", "loc"}
    assert mapping.noise_words(values.limit(0), PLACES) == frozenset() and mapping.noise_words(values, []) == frozenset()


def test_abbreviations():
    m = mapping.Matcher(PLACES)
    assert [m.expanded(w) for w in ("gral", "gnral", "col", "c", "vla", "v", "general", "x", "norte")] == ["general", "general", "colonia", "colonia", "villa", "villa", "general", "x", "norte"]


def test_map_values(spark):
    cells = spark.createDataFrame([(1, "Orlnudo", "a"), (1, "Orlnudo", "a"), (2, None, "b"), (3, "Orlundo", "c")], "lead_id long, valor string, nombre string")
    entries = spark.createDataFrame([(6, "Orlundo"), (2, "Orlundo"), (9, None), (8, " ")], "ref_id long, nombre string")
    got = sorted((r["lead_id"], r["ref_id"]) for r in mapping.map_values(cells, entries).collect())
    assert got == [(1, 2), (1, 2), (2, 0), (3, 2)]
    assert {r["ref_id"] for r in mapping.map_values(cells, entries.limit(0)).collect()} == {0}
    with pytest.raises(ValueError):
        mapping.map_values(cells, entries, max_entries=1)


def test_chains_round_trip():
    """Undoing a chain gives the text before it, for every chain that loses nothing."""
    for text in ("Peñón Güemes", "JOSÉ ÁLVAREZ", "São João"):
        for c in encodings.chains():
            g = encodings.garble(text, c)
            if g is not None and encodings.undo(g, c) is not None:
                assert encodings.undo(g, c) == text


@pytest.mark.parametrize("names", [("utf-8",), ("utf-8",) * 2, ("utf-8",) * 3, ("cp850", "utf-8"), ("utf-8", "cp1252/cp850"), ("utf-8", "cp1252/mac_roman", "utf-8")])
def test_deep_chains(names):
    """Mistakes upon mistakes are undone without the table, if UTF-8 proves them; clean text stays."""
    chain = tuple(tuple(n.split("/")) if "/" in n else (n, "cp1252") for n in names)
    for text in ("Peñón Güemes", "Begoña Núñez", "ColoniaCalgúlundo"):
        assert encodings.restore(encodings.garble(text, chain), []) == text
        assert encodings.restore(text, []) is None


def test_pieces():
    """An original replaces whole tokens only."""
    assert encodings.restore("PeÃ±a xPeÃ±a \u0416", [("PeÃ±a", "Peña", 0)]) == "Peña xPeÃ±a \u0416"


def test_broken_values(spark):
    clean = ["Begoña Núñez", "Óscar Peñón", "João «Tito» Weiß", "Ana", "Peñón", "¿llamar?", "NÃO", None, "", "Zoë (?)", "Calle 2 nº 5"]
    damaged = {
        "Ã\x93scar PeÃ±Ã³n": "Óscar Peñón", "BegoÃƒÂ±a NÃƒÂºÃƒÂ±ez": "Begoña Núñez", "Pe├▒├│n": "Peñón", "Pe–—n": "Peñón", "  Pe¤¢n ": "  Peñón ", "Pe√±√≥n, X": "Peñón, X",
        "Pe?ón": "", "Bego�a": "", "Dorrã\xadn": None, "Quiñihué".encode().decode("latin-1"): "Quiñihué",
    }
    values = clean + list(damaged)
    t = spark.createDataFrame([(i, "nombre", v, "e") for i, v in enumerate(values)], "lead_id long, campo string, valor string, texto_viejo string").drop("texto_viejo")
    got = {values[r["lead_id"]]: r["texto"] for r in encodings.broken_values(t).collect()}
    assert got == {k: v for k, v in damaged.items() if v is not None}
    assert encodings.broken_values(t.limit(0)).count() == 0


def test_forms_not_broadcast(spark):
    """A word makes a hundred forms, which Spark's estimate of the table doesn't know: nothing is broadcast on an estimate."""
    t = spark.createDataFrame([(1, "Begoña"), (2, "BegoÃ±a"), (3, "Ana?")], "lead_id long, valor string")
    out = encodings.broken_values(t)
    assert {tuple(r) for r in out.collect()} == {(2, "Begoña")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@needs_vocabulary
def test_tree_encoding():
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(os.path.join(os.path.dirname(VOCABULARY), "byte_bpe_50k.json"))
    ref.encode_special_tokens = True
    t = tokens.TreeEncoder(VOCABULARY, run_bytes=16)
    rnd = random.Random(7)
    alphabet = ["a", "b", " ", "\n", "'", "s", "é", "1", "2", ".", "!", "  ", "'re", "日本", "😊", "the", "ing", "​", "<|endoftext|>", "\t"]
    for _ in range(1500):
        some = rnd.sample(alphabet, rnd.randint(1, 7))
        x = "".join(rnd.choice(some) for _ in range(rnd.randint(0, 120)))
        want, n = ref.encode(x, add_special_tokens=False).ids, rnd.choice([3, 11, 30])
        assert t.encode(x) == want
        assert t.join_parts([t.split_part(x[k : k + n]) for k in range(0, len(x), n)]) == want


@needs_vocabulary
def test_encode_corpus(spark):
    texts = [None, "", " ", "hola mundo", "a" * 300, "palabra " * 60, "x" * 40 + " " * 50 + "ñ" * 40, "hola mundo"]
    docs = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)] + [(3, "hola mundo", [2])], "doc_id long, text string, ids array<int>")
    t = tokens.TreeEncoder(VOCABULARY)
    want = sorted([(i, t.encode(x)) for i, x in enumerate(texts)] + [(3, t.encode("hola mundo"))])
    for piece in (1 << 20, 32):
        got = tokens.encode_corpus(docs, piece_chars=piece, run_bytes=8).collect()
        assert sorted((r["doc_id"], list(r["ids"])) for r in got) == want
    assert tokens.encode_corpus(docs.limit(0)).count() == 0


def test_words():
    """Vectorised folding is that of the standard library, whatever the slices."""
    import pyarrow as pa

    from tamiz.llm import words as W

    texts = ["Ñandú, ÁRBOL-7 x\u0301y", None, "", "  ", "İstanbul ſtraße K 12é", "日本 abc\n\nd", "a" * 70_000 + " b", "ａｂｃ ½ ²"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    want = [re.findall("[a-z0-9]+", "".join(c for c in unicodedata.normalize("NFD", (t or "").lower()) if not "\u0300" <= c <= "\u036f")) for t in texts]
    for size in (8 << 20, 1000, 1):
        W.SLICE_BYTES, kept = size, W.SLICE_BYTES
        got = []
        for part in W.slices(batch, "t"):
            w = W.split_words(W.lowered(part.column("t")))
            got += [[w.vocabulary[i] for i in w.index[a : a + n]] for a, n in zip(w.start, w.size)]
        W.SLICE_BYTES = kept
        assert got == want
    broken = pa.array([b"abc \xff def", b"x"], pa.binary()).view(pa.string())
    assert [W.split_words(W.lowered(broken)).vocabulary] == [["abc", "def", "x"]]


def test_bit_filter(spark):
    from tamiz.llm import words as W

    import numpy as np

    rnd = np.random.default_rng(1)
    inside = rnd.integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64)
    bits = W.bit_filter(spark.createDataFrame([(int(x),) for x in inside], "h long"), "h").value
    assert W.passes(bits, inside.view(np.uint64)).all() and W.passes(bits, rnd.integers(0, 2**63, 5000, dtype=np.int64).view(np.uint64)).mean() < 0.1


@pytest.mark.parametrize("small", [200_000, 3])
def test_leaks_brute(spark, small):
    rnd = random.Random(9)
    word = lambda: rnd.choice("uno dos tres ÁRBOL señal 7 ocho".split())
    items = [(i, " ".join(word() for _ in range(rnd.choice([4, 9, 14])))) for i in range(12)] + [(50, None), (51, "")]
    docs = [(i, ", ".join(word() for _ in range(20))) for i in range(30)]
    docs += [(100 + i, f"antes {t.upper() if t else ''}.\n después") for i, t in items] + [(200, None), (201, ""), (201, "")]
    ws = lambda t: re.findall("[a-z0-9]+", "".join(c for c in unicodedata.normalize("NFD", (t or "").lower()) if not "̀" <= c <= "ͯ"))
    run = lambda t, n: {tuple(ws(t)[k : k + n]) for k in range(len(ws(t)) - n + 1)}
    want = {(d, i) for d, x in docs for i, t in items if run(x, 6) & run(t, 6)}
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), run=6, k=3, max_broadcast=small).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and want


@pytest.mark.parametrize("small", [200_000, 1])
def test_leaks_null_ids(spark, small):
    docs = [(None, "x uno dos tres cuatro y"), (None, "nada de eso"), (1, "uno dos tres cuatro"), (2, "uno dos")]
    items = [(7, "uno dos tres cuatro"), (None, "dos tres cuatro y")]
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), run=4, k=2, max_broadcast=small).collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 7)", "(None, 7)", "(None, None)"]


def test_truncated(spark):
    rnd = random.Random(2)
    ends = ["llamar a la tarde", "pide el contrato por escrito", "quiere hablar con la encargada", "no contesta el telefono"]
    docs = [(i, "notas", ". ".join(rnd.choice(ends) for _ in range(3)) + rnd.choice([".", ".", ".", ""])) for i in range(400)]
    docs += [(1000, "notas", "no contesta el tele"), (1001, "notas", "no contesta el telefono..."), (1002, "notas", "quiere hablar con la"), (1003, "notas", "llamar a la tarde,"), (1004, None, "pide el contra…"), (1005, "notas", None), (1006, "notas", "  "), (1007, "notas", "llamar a la tarde. (ver ficha)")]
    docs += [(2000 + i, "sms", (" ".join(rnd.choice(ends) for _ in range(9)))[:80]) for i in range(40)]
    t = spark.createDataFrame([(*d, "e") for d in docs], "doc_id long, source string, text string, motivo string")
    got = {r["doc_id"]: r["motivo"] for r in truncation.truncated(t).collect()}
    assert {k: v for k, v in got.items() if k < 2000} == {1000: "palabra", 1002: "frase", 1003: "colgada", 1004: "palabra"}
    assert all(got.get(2000 + i) == "limite" for i in range(40))
    assert truncation.truncated(t.limit(0)).count() == 0


def test_rare_stumps(spark):
    """A stray stump elsewhere doesn't hide a cut word; rare whole words stay."""
    docs = [(i, "notas", "no contesta el telefono. llamar a la tarde.") for i in range(150)]
    docs += [(500, "notas", "dice que el tele no anda."), (501, "notas", "no contesta el tele"), (502, "notas", "dejar una nota."), (503, "notas", "toma nota y notar que falta."), (504, "notas", "llamar por la nota")]
    docs += [(505, "notas", "vino con la tard y se fue. esta es la tard."), (506, "notas", "llamar por la tard"), (507, "notas", "un contes que no es."), (508, "notas", "no contes")]
    t = spark.createDataFrame(docs, "doc_id long, source string, text string")
    for small in (1_000_000, 1):
        assert {r["doc_id"]: r["motivo"] for r in truncation.truncated(t, max_broadcast=small).collect()} == {501: "palabra", 508: "palabra"}
