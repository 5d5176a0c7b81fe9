"""Delivered records parsed in bulk; those that can't be loaded come out with the reason.

Blocks of raw records go through Arrow's columnar CSV reader. A block that does not come
back exactly as it went in is bisected until the bad records stand alone, and only those
are diagnosed by a strict character-level reader.
"""

from __future__ import annotations

import io
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.dates import load_date
from tamiz.functions.phone import phone_type
from tamiz.functions.text import PY_WS, is_blank
from tamiz.session import once, small_side

QUOTES, COLUMNS, VALUE, NO_LOT = "comillas", "columnas", "valor", "sin lote"
_STRICT_SIZE = 1


def diagnose(record: str, sep: str) -> tuple[str | None, list[str]]:
    """Strict reading of one record: (`comillas` or None, fields as far as read).

    A quote opens a field only as its first character, a doubled quote stands for a quote inside,
    and after the closing quote only the separator or the end may follow. Line breaks are characters.
    """
    fields, i, n = [], 0, len(record)
    while True:
        if i < n and record[i] == '"':
            j, parts = i + 1, []
            while True:
                k = record.find('"', j)
                if k < 0:
                    return QUOTES, fields
                parts.append(record[j:k])
                if record.startswith('""', k):
                    parts.append('"')
                    j = k + 2
                    continue
                i = k + 1
                break
            fields.append("".join(parts))
            if i < n and not record.startswith(sep, i):
                return QUOTES, fields
        else:
            k = record.find(sep, i)
            k = n if k < 0 else k
            fields.append(record[i:k])
            i = k
        if i >= n:
            return None, fields
        i += len(sep)


_SOMETHING = re.compile(rf"[^{PY_WS[1:-1]}]")


def judge(record: str, sep: str, width: int) -> tuple[str | None, list[str]]:
    """Reason and fields of one record by the strict reader; a record of blank fields has no reason."""
    reason, fields = diagnose(record, sep)
    if reason is None and len(fields) != width:
        reason = COLUMNS if any(_SOMETHING.search(x) for x in fields) else None
    return reason, fields


def parse_block(records: list[str], sep: str, width: int, out: list, at: list[int]) -> None:
    """Read `records` as one block, bisecting while it fails; `out[at[k]]` gets (reason, fields)."""
    if len(records) <= _STRICT_SIZE:
        for k, r in zip(at, records):
            out[k] = judge(r, sep, width)
        return
    columns = _bulk(records, sep, width)
    if columns is None:
        half = len(records) // 2
        parse_block(records[:half], sep, width, out, at[:half])
        parse_block(records[half:], sep, width, out, at[half:])
        return
    for k, row in zip(at, zip(*columns)):
        out[k] = (None, list(row))


@lru_cache(maxsize=64)
def _grammar(sep: str) -> re.Pattern:
    """Well-quoted records, one a line; possessive, so it never backtracks."""
    q = re.escape(sep)
    field = rf'(?:"(?:[^"]++|"")*+"|[^"{q}\n][^{q}\n]*+|)'
    return re.compile(rf"{field}(?:{q}{field})*+(?:\n{field}(?:{q}{field})*+)*+")


def _bulk(records: list[str], sep: str, width: int) -> list[list[str]] | None:
    """Columns of the block, or None unless every record surely reads the same under the strict rules.

    Each record is prefixed by its number and a full-width guard record ends the block, so a record that
    swallows or splits a neighbour can't go unseen. Arrow is lenient after a closing quote, so the
    block must also match the strict grammar as a whole.
    """
    import pyarrow as pa
    from pyarrow import csv

    if len(sep) != 1 or sep in '"\r\n':
        return None
    text = "\n".join(f"{i}{sep}{r}" for i, r in enumerate(records))
    if "\r" in text or "\0" in text or not _grammar(sep).fullmatch(text):
        return None
    text += f"\n{len(records)}{sep * width}"
    names = [str(i) for i in range(width + 1)]
    try:
        t = csv.read_csv(
            io.BytesIO(text.encode("utf-8", "surrogatepass")),
            read_options=csv.ReadOptions(column_names=names, use_threads=False, block_size=len(text) * 4 + 64),
            parse_options=csv.ParseOptions(delimiter=sep, quote_char='"', double_quote=True, newlines_in_values=True, ignore_empty_lines=False),
            convert_options=csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False, quoted_strings_can_be_null=False),
        )
    except (pa.ArrowInvalid, UnicodeError):
        return None
    if t.column(0).to_pylist() != [str(i) for i in range(len(records) + 1)]:
        return None
    return [c.to_pylist()[:-1] for c in t.columns[1:]]


def _reader(block: int):
    def read(batches):
        import pandas as pd

        for pdf in batches:
            out: list = [(None, [])] * len(pdf)
            for (sep, width), part in pdf.groupby(["__sep", "__width"], sort=False, dropna=True):
                rows, texts = part["__pos"].tolist(), part["__rec"].tolist()
                for i in range(0, len(rows), block):
                    parse_block(texts[i : i + block], sep, int(width), out, rows[i : i + block])
            got = pd.DataFrame({"__key": pdf["__key"], "motivo": [r for r, _ in out], "campos": [f for _, f in out]})
            yield got

    return read


def load_records(records: DataFrame, lots: DataFrame, block: int = 512, max_lots: int = 100_000) -> DataFrame:
    """Parse `records(registro_id, archivo_id, linea, c0)` by their lot's separator and width.

    Gives one row per data record (below its lot's header): `registro_id, archivo_id, linea, campos, motivo`.
    `motivo` is null for a valid row, else the first of `comillas`, `columnas`, `valor`; a record whose
    lot is unknown or has no separator or width comes out as `sin lote`. One final carriage return is not part
    of the record. Null, empty and blank records are valid with whatever fields they have. Repeated rows
    stay repeated; empty tables give no rows; further columns of either table don't matter.
    No shuffle: lots are broadcast if counted at most `max_lots`, blocks of `block` records are parsed where they lie.
    """
    lot = lots.select(
        "archivo_id", F.col("separador").alias("__sep"), F.col("n_columnas").alias("__width"),
        F.col("linea_encabezado").alias("__head"), F.col("col_telefono").alias("__tel"), F.col("col_fecha").alias("__day"),
    ).dropDuplicates(["archivo_id"])
    rows = records.select("registro_id", "archivo_id", "linea", "c0").join(small_side(lot, max_lots), "archivo_id", "left")
    rows = rows.where(F.col("__head").isNull() | (F.col("linea") > F.col("__head")))
    rows = rows.select("*", F.regexp_replace(F.coalesce("c0", F.lit("")), r"\r\z", "").alias("__rec"))
    keyed = rows.select(F.struct("registro_id", "archivo_id", "linea", "__sep", "__width", "__tel", "__day").alias("__key"), "__sep", "__width", "__rec")
    schema = f"__key {keyed.schema['__key'].dataType.simpleString()}, motivo string, campos array<string>"

    def number(batches):
        inner = _reader(block)

        def with_pos():
            for pdf in batches:
                yield pdf.reset_index(drop=True).assign(__pos=range(len(pdf)))

        return inner(with_pos())

    parsed = keyed.mapInPandas(number, schema).select("__key.*", "motivo", "campos")
    field = lambda i: F.get(F.col("campos"), F.col(i))
    wrong = (~is_blank(field("__tel")) & (phone_type(field("__tel")) == "invalido")) | (~is_blank(field("__day")) & load_date(field("__day")).isNull())
    whole = F.size("campos") == F.col("__width")
    reason = F.coalesce(F.when(F.col("__sep").isNull() | F.col("__width").isNull(), NO_LOT), "motivo", F.when(whole & wrong, VALUE))
    return once(parsed, __why=reason).select(
        "registro_id", "archivo_id", "linea", "campos", F.col("__why").alias("motivo")
    )


def bad_phones(leads: DataFrame) -> DataFrame:
    """`registro_id, motivo` of leads whose phone is not blank and invalid."""
    tel = F.col("telefono")
    return leads.where(~is_blank(tel) & (phone_type(tel) == "invalido")).select(F.col("lead_id").alias("registro_id"), F.lit(VALUE).alias("motivo"))


def found(spark, sf_dir: str) -> DataFrame:
    """Problem 1: what can't be loaded, with its table and reason."""
    raw, lead = "leads_adversario_2", "leads_prueba_sintetico_1"
    records = spark.read.parquet(f"{sf_dir}/{raw}.parquet")
    lots = spark.read.parquet(f"{sf_dir}/archivos.parquet")
    loaded = load_records(records, lots)
    a = loaded.where(F.col("motivo").isin(QUOTES, COLUMNS, VALUE)).select(F.lit(raw).alias("tabla"), "registro_id", "motivo")
    b = bad_phones(spark.read.parquet(f"{sf_dir}/{lead}.parquet")).select(F.lit(lead).alias("tabla"), "registro_id", "motivo")
    return a.unionByName(b)
