"""Client files as raw records: encoding, separator, and a Python data source that keeps every record's width."""

from __future__ import annotations

import codecs
import csv
import io
import os
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import islice
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tamiz.functions.text import py_trim, text_or_empty
from tamiz.operators.order import with_position
from tamiz.sources.files import list_files, open_bytes

CHUNK = 1 << 20
# Separators that are tried, with their names.
SEPARATORS = ((",", "coma"), (";", "punto y coma"), ("\t", "tabulador"))
REPLACEMENT = "�"


class Unreadable(ValueError):
    """The file is no table the rules accept: (found, expected)."""

    def __init__(self, found: str, expected: str):
        super().__init__(f"{found} (hace falta {expected})")
        self.found, self.expected = found, expected


def detect_encoding(path: str) -> tuple[str, bool]:
    """('utf-8' or 'latin-1', byte order mark?) in one streaming pass. Text that holds U+FFFD after decoding counts as Latin-1."""
    with open_bytes(path) as f:
        data = f.read(3)
        bom = data == codecs.BOM_UTF8
        decoder = codecs.getincrementaldecoder("utf-8")()
        data = b"" if bom else data
        try:
            while True:
                more = f.read(CHUNK)
                if REPLACEMENT in decoder.decode(data + more, final=not more):
                    return "latin-1", bom
                if not more:
                    return "utf-8", bom
                data = b""
        except UnicodeDecodeError:
            return "latin-1", bom


@contextmanager
def open_text(path: str, encoding: str, bom: bool) -> Iterator[TextIO]:
    """The file's text without its mark, line ends as they are."""
    with open_bytes(path) as f:
        if bom:
            f.read(3)
        yield io.TextIOWrapper(f, encoding=encoding, newline="")


def records(text: Iterable[str], sep: str) -> Iterator[list[str]]:
    """Fields of each record of the lines of `text`, streaming. A quote opens only at a field's start, doubled quotes stand
    for one, line breaks inside quotes belong to the value, any of LF, CRLF and CR ends a record, an unfinished last record is kept."""
    csv.field_size_limit(sys.maxsize)
    for fields in csv.reader(text, delimiter=sep):
        yield fields or [""]


def count_fields(line: str, sep: str) -> int:
    """Fields of a line, separators inside quotes not counted."""
    return 1 + sum(part.count(sep) for part in line.split('"')[::2])


def support(lines: list[str], sep: str) -> float:
    """Share of the lines that have the separator's prevailing width, 0 if it doesn't prevail.

    Lines the separator doesn't split say nothing about the width, but they do count as lines: the prevailing width must
    hold for 80 % of the split lines and for half of all.
    """
    split = [n for n in (count_fields(x, sep) for x in lines) if n > 1]
    top = Counter(split).most_common(1)
    agree = top[0][1] if top else 0
    return agree / len(lines) if agree and 5 * agree >= 4 * len(split) and 2 * agree >= len(lines) else 0.0


def sniff_separator(lines: list[str]) -> tuple[str, str]:
    """(separator, name) with the most support among up to ten non-blank lines; none, or a tie, raises Unreadable."""
    if not lines:
        raise Unreadable("no hay ninguna linea con texto", "titulos y contactos")
    held = {pair: support(lines, pair[0]) for pair in SEPARATORS}
    most = max(held.values())
    best = [pair for pair, share in held.items() if share == most and share]
    if len(best) != 1:
        names = " y ".join(name for _, name in best)
        raise Unreadable(f"{names} parten igual de bien las {len(lines)} primeras lineas" if best else f"nada parte en un mismo ancho las {len(lines)} primeras lineas", "un separador claro")
    return best[0]


def first_lines(path: str, encoding: str, bom: bool, n: int = 10) -> list[str]:
    """The first `n` non-blank lines."""
    with open_text(path, encoding, bom) as text:
        return list(islice((x.rstrip("\r\n") for x in text if py_trim(x)), n))


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.sep, self.encoding, self.bom = options["path"], options["sep"], options.get("encoding", ""), options.get("bom", "")

    def partitions(self):
        return [_File(p) for p in list_files(self.path)]

    def read(self, partition):
        encoding, bom = (self.encoding, self.bom == "true") if self.encoding else detect_encoding(partition.path)
        with open_text(partition.path, encoding, bom) as text:
            for i, fields in enumerate(records(text, self.sep), 1):
                yield os.path.basename(partition.path), i, fields


class DelimitedSource(DataSource):
    """`archivo, registro, campos`: every record of delimited files with its number and all its fields; a task per file."""

    @classmethod
    def name(cls):
        return "tamiz_delimited"

    def schema(self):
        return "archivo string, registro bigint, campos array<string>"

    def reader(self, schema):
        return _Reader(self.options)


def read_records(spark: SparkSession, path: str, sep: str, encoding: str = "", bom: bool = False) -> DataFrame:
    """Records of one file, or of a folder or glob of files that share a separator; streamed by the executors, never held whole.
    A known encoding spares each task looking for it."""
    spark.dataSource.register(DelimitedSource)
    return spark.read.format("tamiz_delimited").option("sep", sep).option("encoding", encoding).option("bom", str(bom).lower()).load(path)


def read_plain(spark: SparkSession, path: str) -> DataFrame:
    """A clean comma file with its titles in the first line, by Spark's own reader: all columns as text, null as '', and
    `id_fila`, the position in the file (S1). Nothing is sniffed, mapped or judged; that is the gate's work."""
    rows = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    texts = rows.select(*[text_or_empty(F.col(f"`{c}`")).alias(c) for c in rows.columns], F.monotonically_increasing_id().alias("__at"))
    return with_position(texts, [F.col("__at").asc()], "id_fila").drop("__at")
