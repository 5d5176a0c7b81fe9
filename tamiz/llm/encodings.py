"""Text decoded with the wrong character encoding: find it, and restore it where nothing was lost.

Garbled forms of every clean corpus word under every encoding chain make a table; suspect tokens are
hash-joined against it. The chain that a hit names is undone on the whole value, and the result
counts only if garbling it again gives exactly the value found.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Encodings that Western text is written in and mistaken for.
WRITTEN = ("utf-8", "cp1252", "cp850", "cp437", "mac_roman")
READ_AS = ("cp1252", "latin-1", "cp850", "cp437", "mac_roman")

# Letters beyond ASCII of the languages in use (Spanish, Portuguese, German, French names).
LETTERS = "áéíóúüñãõâêôàçëïöäèìòùîûÿœæøåß"
#: Letters and marks that clean words may have beyond ASCII.
MARKS = "ºª’‘“”«»¿¡—–·"
LOST = "\uFFFD"


@lru_cache(maxsize=None)
def _decoder(name: str) -> tuple[str, ...]:
    """Character of each byte; bytes the encoding leaves open become the control character of the same number."""
    return tuple(bytes([b]).decode(name, "ignore") or chr(b) for b in range(256))


@lru_cache(maxsize=None)
def _encoder(name: str) -> dict[str, int]:
    return {ch: b for b, ch in reversed(list(enumerate(_decoder(name))))}


def _encode(text: str, name: str) -> bytes | None:
    if name == "utf-8":
        try:
            return text.encode("utf-8")
        except UnicodeEncodeError:
            return None
    table = _encoder(name)
    try:
        return bytes([table[ch] for ch in text])
    except KeyError:
        return None


def _decode(data: bytes, name: str) -> str | None:
    if name == "utf-8":
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return None
    return "".join(map(_decoder(name).__getitem__, data))


@lru_cache(maxsize=1)
def _singles() -> tuple[tuple[tuple[str, str], ...], ...]:
    return tuple(c for c in chains() if len(c) == 1)


@lru_cache(maxsize=1)
def chains() -> tuple[tuple[tuple[str, str], ...], ...]:
    """Every (written, read) mistake, and two UTF-8 mistakes one after the other."""
    single = [((w, r),) for w in WRITTEN for r in READ_AS if w != r and {w, r} != {"cp1252", "latin-1"}]
    utf = [c for c in single if c[0][0] == "utf-8"]
    return tuple(single + [a + b for a in utf for b in utf])


def garble(text: str, chain) -> str | None:
    for written, read in chain:
        data = _encode(text, written)
        if data is None:
            return None
        text = _decode(data, read)
    return text


def undo(text: str, chain) -> str | None:
    """The text before the chain, or None if the chain can't have made it."""
    out = text
    for written, read in reversed(chain):
        data = _encode(out, read)
        if data is None:
            return None
        out = _decode(data, written)
        if out is None:
            return None
    return out if garble(out, chain) == text else None


_WORD = re.compile(rf"[A-Za-z{LETTERS}{LETTERS.upper().replace('SS', '')}]+")
_CASED = re.compile(r"\A(?:[^\W\d_]?[^A-ZÁÉÍÓÚÜÑÃÕÂÊÔÀÇËÏÖÄÈÌÒÙÎÛŒÆØÅ\W\d_]*|[^a-záéíóúüñãõâêôàçëïöäèìòùîûœæøå\W\d_]+)\Z")


def is_clean_word(word: str) -> bool:
    """Only letters of the languages in use, in lower, upper or title case."""
    return bool(_WORD.fullmatch(word) and _CASED.fullmatch(word))


#: Splits off everything that no garbled letter can turn into: ASCII other than letters.
TOKEN_SPLIT = r"[\x00-\x20!->@\[-`{-~]+"


@lru_cache(maxsize=1)
def _usual() -> frozenset[str]:
    return frozenset(LETTERS + LETTERS.upper() + MARKS + "\xa0") | frozenset(map(chr, range(128)))


#: Letters that settle a tie between chains: those of Spanish and Portuguese.
_COMMON = frozenset("áéíóúüñãõâêôàçÁÉÍÓÚÜÑÃÕÂÊÔÀÇ" + MARKS + "\xa0")
_PARTS = re.compile(f"[{MARKS}?]+")
_INNER_LOSS = re.compile(r"[^\W\d_]\?+[^\W\d_]|\A\s*\?+[^\W\d_]|\s\?+[^\W\d_]")


def is_clean_token(token: str) -> bool:
    """Clean words and marks only, with at least one letter beyond ASCII or mark, and two characters of words."""
    words = [x for x in _PARTS.split(token) if x]
    return not token.isascii() and len("".join(words)) > 1 and all(map(is_clean_word, words))


def table_rows(token: str) -> list[tuple[str, str, int]]:
    """(form, original, chain number) for a clean corpus token in its usual cases; chain -1 is a lossy conversion."""
    out = []
    for word in sorted({token, token.lower(), token.upper(), token.title()}):
        out += [(g, word, i) for i, c in enumerate(chains()) if (g := garble(word, c)) is not None and g != word]
        lossy = {re.sub(r"[^\x00-\x7f]", r, word) for r in ("?", LOST, "??", LOST * 2)}
        # Of a lossy form only its being one matters, not which word lost its letters.
        out += [(g, "", -1) for g in sorted(lossy) if g != word]
    return out


#: Mistakes, one upon the other, that are undone on a value no word of which is in the table.
DEPTH = 3
_PIECES = re.compile(f"({TOKEN_SPLIT})")


def restore(value: str, hits: list[tuple[str, str, int]], depth: int = DEPTH) -> str | None:
    """The value before the damage, '' if characters were lost, None if it isn't broken.

    `hits` are the table's (token, original, chain) for tokens of the value. The chains they name are undone on the
    whole value; if none explains all of it, the verified originals replace their tokens. A value with
    no hit is tried against mistakes that prove themselves, up to `depth` of them one upon the other.
    """
    if LOST in value:
        return ""
    if any(c < 0 for _, _, c in hits):
        return ""
    best = _best(value, sorted({c for _, _, c in hits}))
    if best is None and hits:
        first = {token: original for token, original, _ in sorted(hits, reverse=True)}
        return "".join(first.get(piece, piece) for piece in _PIECES.split(value))
    if best is None and not value.isascii():
        found = sorted(_peeled(value, depth, 1))
        best = found[0][-1] if found else None
    if best is None and "¿" not in value and _INNER_LOSS.search(value):
        return ""
    return best


def _peeled(value: str, depth: int, other: int, past: tuple[int, ...] = ()) -> list[tuple]:
    """Ranked readings of a value without its mistakes, outermost first.

    UTF-8 sequences prove themselves, so each such mistake may be undone; beside them at most `other` single-byte mistakes, and only where
    a character is one that no clean text has. A reading counts only with the letters of the languages at hand.
    """
    out = []
    odd = not set(value) <= _usual()
    for i, chain in enumerate(_singles()):
        utf = chain[0][0] == "utf-8"
        if not utf and not (odd and other):
            continue
        t = undo(value, (chain[0],))
        if t is None or t == value:
            continue
        clean = set(t) <= _usual()
        if clean and not any(not ch.isascii() and ch not in _COMMON for ch in t):
            out.append((*_worth(t), not utf, -len(past), (i, *past), t))
        if depth > 1 and not t.isascii():
            # What is read here may itself be damaged; a second single-byte mistake proves nothing.
            out += _peeled(t, depth - 1, other - (not utf), (i, *past))
    return out


def _worth(text: str) -> tuple[int, int, int]:
    """(odd characters, unclean words, rare letters); less is better."""
    odd = sum(ch not in _usual() for ch in text)
    unclean = sum(not is_clean_word(w) for w in re.split(rf"[{MARKS}\xa0\x00-@\[-`{{-~]+", text) if w)
    return odd, unclean, sum(not ch.isascii() and ch not in _COMMON for ch in text)


def _best(value: str, numbers) -> str | None:
    found = []
    for i in numbers:
        t = undo(value, chains()[i])
        if t is not None and t != value:
            found.append((*_worth(t), chains()[i][0][0] != "utf-8", -len(chains()[i]), i, t))
    return min(found)[-1] if found else None


def _spread(df, column, pattern: str):
    """One row per token of `column`, split at `pattern`."""
    from pyspark.sql import functions as F

    return df.withColumn("token", F.explode(F.split(column, pattern)))


def broken_values(cells, corpora: list | None = None):
    """`[keys], texto` for the broken rows of `cells(keys..., valor)`; `texto` as `restore` gives it.

    `cells` needs unique key columns beside `valor`. Corpus words are counted over all cells and the
    string columns `valor` of `corpora`. Work is on distinct words: each distinct clean word is garbled once, and only tokens with
    a character beyond ASCII or a question mark are looked up. A token that is clean itself counts as garbled only if it is not
    more frequent than its original. Null and empty values are never broken; an empty table gives no rows.

    No join here may broadcast on Spark's estimate: it sizes the table of forms by its words, each of which makes a hundred forms, and
    the tokens by the compressed files, and would send the driver more than it can hold.
    """
    from pyspark.sql import functions as F

    from tamiz.operators.skew import skewed_lookup
    from tamiz.session import cut

    keys = [c for c in cells.columns if c != "valor"]
    if {"token", "hits", "texto"} & set(keys):
        raise ValueError("key columns can't be named token, hits or texto")
    suspect = F.col("valor").rlike(r"[^\x00-\x7F]|\?")
    odd = F.col("token").rlike(r"[^\x00-\x7F]")
    texts = cells.select("valor")
    for other in corpora or []:
        texts = texts.unionByName(other.select("valor"))
    words = _spread(texts.where(F.col("valor").rlike(r"[^\x00-\x7F]")), F.col("valor"), rf"{TOKEN_SPLIT}|\u00A0").where(odd)
    words = cut(words.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    spark = cells.sparkSession
    # A few words make many forms: every core gets its share of the words, however small their table is.
    spread = words.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def forms(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(*r, int(n)) for t, n in zip(pdf["token"], pdf["n"]) if is_clean_token(t) for r in table_rows(t)]
            yield pd.DataFrame(rows, columns=["token", "original", "cadena", "n_original"])

    table = spread.mapInPandas(forms, "token string, original string, cadena int, n_original bigint")

    def marked(batches):
        for pdf in batches:
            yield pdf.assign(limpio=[is_clean_token(t) for t in pdf["token"]])

    broken = cut(cells.where(suspect))
    tokens = _spread(broken.select(*keys, "valor"), F.col("valor"), TOKEN_SPLIT).where(F.col("token").rlike(r"[^\x00-\x7F]|\?") & F.col("token").rlike(r"[^\x00-@\[-`{-~]"))
    tokens = cut(tokens.select(*keys, "token").distinct())
    asked = tokens.select("token").distinct().join(words.hint("merge"), "token", "left").na.fill(0, ["n"]).mapInPandas(marked, "token string, n bigint, limpio boolean")
    hit = asked.join(table.hint("merge"), "token").where("not limpio or n_original >= n")
    hit = hit.groupBy("token").agg(F.collect_set(F.struct("original", "cadena")).alias("hits"))
    per = skewed_lookup(tokens, hit.hint("merge"), "token")
    per = per.select(*keys, F.transform("hits", lambda h: F.struct(F.col("token").alias("token"), h["original"].alias("original"), h["cadena"].alias("cadena"))).alias("hits"))
    per = per.groupBy(*keys).agg(F.flatten(F.collect_list("hits")).alias("hits"))
    rows = broken.join(per.hint("merge"), keys, "left")
    schema = ", ".join(f"`{k}` {cells.schema[k].dataType.simpleString()}" for k in keys) + ", texto string"

    def mend(batches):
        import pyarrow as pa

        for b in batches:
            pairs = zip(b.column("valor").to_pylist(), b.column("hits").to_pylist())
            texts = pa.array([restore(v, [(x["token"], x["original"], x["cadena"]) for x in h or []]) for v, h in pairs], pa.string())
            out = pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], texts], [*keys, "texto"])
            yield out.filter(texts.is_valid())

    return rows.mapInArrow(mend, schema)


def found(spark, sf_dir: str):
    """Problem 7: broken values of `nombre` and `localidad` with the text before the damage."""
    from pyspark.sql import functions as F

    def values(df, *columns):
        return df.select("*", F.inline(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(c).alias("valor")) for c in columns])))

    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    leads = read("leads_prueba_sintetico_1").select("lead_id", "nombre", "localidad")
    cells = values(leads, "nombre", "localidad").select("lead_id", "campo", "valor").where("valor is not null")
    corpora = [values(read("localidades_ref").select("nombre"), "nombre"), values(read("salida_adv1").select("nombre", "localidad"), "nombre", "localidad")]
    return broken_values(cells, corpora)
