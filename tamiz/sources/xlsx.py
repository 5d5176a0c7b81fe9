"""First sheet of a spreadsheet by the standard library: zip and XML, inline and shared strings, numbers."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tamiz.sources.files import open_bytes

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def number_text(value: str) -> str:
    """A numeric cell as text: whole numbers without a decimal point."""
    x = float(value)
    return str(int(x)) if x.is_integer() and abs(x) < 1e21 else repr(x)


def open_book(path: str) -> zipfile.ZipFile:
    """The workbook's archive; the directory at its end makes it be read whole."""
    with open_bytes(path) as f:
        return zipfile.ZipFile(io.BytesIO(f.read()))


def check_book(path: str) -> None:
    """Raises ValueError for what isn't a readable workbook: the old binary format, a cut or damaged archive, no sheet."""
    try:
        with open_book(path) as z:
            sheets = [n for n in z.namelist() if n.startswith("xl/worksheets/")]
            if not sheets or z.testzip() is not None:
                raise ValueError("no whole sheet")
            for n in {*sheets[:1], "xl/worksheets/sheet1.xml"} & set(sheets):
                for _, e in ET.iterparse(z.open(n)):
                    e.clear()
    except (zipfile.BadZipFile, ET.ParseError, zlib.error, EOFError, NotImplementedError, RuntimeError) as e:
        raise ValueError(str(e)) from e


def rows(path: str) -> Iterator[tuple[list[str], list[bool]]]:
    """(texts, numeric?) of each non-empty row, streaming; missing cells are ''."""
    with open_book(path) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for _, si in ET.iterparse(z.open("xl/sharedStrings.xml")):
                if si.tag == f"{_NS}si":
                    shared.append("".join(t.text or "" for t in si.iter(f"{_NS}t")))
        sheet = next(n for n in ("xl/worksheets/sheet1.xml", *sorted(x for x in names if x.startswith("xl/worksheets/"))) if n in names)
        for _, row in ET.iterparse(z.open(sheet)):
            if row.tag != f"{_NS}row":
                continue
            texts: list[str] = []
            numeric: list[bool] = []
            for k, c in enumerate(row.findall(f"{_NS}c")):
                at = _column(c.get("r")) if c.get("r") else k
                while len(texts) <= at:
                    texts.append("")
                    numeric.append(False)
                kind, v = c.get("t", "n"), c.find(f"{_NS}v")
                if kind == "inlineStr":
                    texts[at] = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
                elif v is not None and v.text is not None:
                    if kind == "s":
                        texts[at] = shared[int(v.text)]
                    elif kind == "n":
                        texts[at], numeric[at] = v.text, True
                    else:
                        texts[at] = v.text
            row.clear()
            if any(texts):
                yield texts, numeric


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [InputPartition(self.path)]

    def read(self, partition):
        for i, (texts, numeric) in enumerate(rows(partition.value), 1):
            yield i, [number_text(t) if n else t for t, n in zip(texts, numeric)], numeric


class SpreadsheetSource(DataSource):
    """`registro, campos, numericos` of the first sheet."""

    @classmethod
    def name(cls):
        return "tamiz_xlsx"

    def schema(self):
        return "registro bigint, campos array<string>, numericos array<boolean>"

    def reader(self, schema):
        return _Reader(self.options["path"])


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(SpreadsheetSource)
    return spark.read.format("tamiz_xlsx").load(path)
