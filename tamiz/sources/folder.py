"""Many client files at once, each with its own encoding, separator, header line and titles.

A task takes a file: it surveys it in one streaming pass, judges it by the gate's rules and emits its contacts in
another. The driver only sees the list of files; verdicts come back as a table, one row a file.
"""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tamiz.functions.text import py_fold, py_trim
from tamiz.plans.config import CANONICAL, check_mapping
from tamiz.sources.delimited import Unreadable, detect_encoding, first_lines, open_text, records, sniff_separator
from tamiz.sources.files import list_files
from tamiz.sources.gate import resolve_headers

_LEADS = "archivo string, registro bigint, " + ", ".join(f"{c} string" for c in CANONICAL) + ", extras map<string,string>"
_VERDICTS = "archivo string, estado string, motivo string, codificacion string, separador string, linea_encabezado bigint, filas bigint, en_blanco bigint, cortas bigint, recortadas bigint, sin_campos bigint"


@dataclass
class Survey:
    """What a file is like, and why it doesn't enter if it doesn't."""

    archivo: str
    estado: str = "ENTRA"
    motivo: str | None = None
    codificacion: str | None = None
    separador: str | None = None
    linea_encabezado: int | None = None
    filas: int = 0
    en_blanco: int = 0
    cortas: int = 0
    recortadas: int = 0
    sin_campos: int = 0


def _blank(fields: list[str]) -> bool:
    return not any(py_trim(x) for x in fields)


class _Gate:
    """One file under the gate's rules, without Spark."""

    def __init__(self, path: str, mapping: dict | None, synonyms: dict | None):
        self.path, self.mapping, self.synonyms = path, mapping, synonyms
        self.seen = Survey(os.path.basename(path))

    def _records(self):
        with open_text(self.path, self.encoding, self.bom) as text:
            yield from enumerate(records(text, self.sep), 1)

    def judge(self) -> Survey:
        try:
            self._judge()
        except Unreadable as e:
            self.seen.estado, self.seen.motivo = "NO ENTRA", str(e)
        return self.seen

    def _judge(self) -> None:
        s = self.seen
        self.encoding, self.bom = detect_encoding(self.path)
        s.codificacion = self.encoding
        self.sep, s.separador = sniff_separator(first_lines(self.path, self.encoding, self.bom))
        # Records, and the first of them, by width; the header is the first record of the prevailing width.
        widths: dict[int, list[int]] = {}
        for i, fields in self._records():
            if len(fields) > 1 and not _blank(fields):
                widths.setdefault(len(fields), [0, i])[0] += 1
        if not widths:
            raise Unreadable("ningun registro se parte en campos", "registros de dos campos o mas")
        self.width = max(widths, key=lambda w: (widths[w][0], -widths[w][1]))
        s.linea_encabezado = widths[self.width][1]
        self.headers = next([py_trim(x) for x in f] for i, f in self._records() if i == s.linea_encabezado)
        self.found = resolve_headers(self.headers, self.mapping, self.synonyms)
        missing = [c for c in CANONICAL if c not in self.found]
        if missing:
            raise Unreadable(f"ningun titulo da {', '.join(missing)}; los titulos son {', '.join(self.headers)}", "nombrarlos en el mapa o entre los sinonimos")
        for i, fields in self._records():
            if i <= s.linea_encabezado:
                continue
            if _blank(fields):
                s.en_blanco += 1
                continue
            s.filas += 1
            s.cortas += len(fields) < self.width
            if len(fields) > self.width:
                if not _blank(fields[self.width :]):
                    raise Unreadable(f"el registro {i} trae datos mas alla de los {self.width} titulos ({len(fields)} campos)", "que todo dato tenga su titulo")
                s.recortadas += 1
            s.sin_campos += _blank([fields[k] for k, _ in self.found.values() if k < len(fields)])
        if not s.filas:
            raise Unreadable("bajo los titulos no hay ningun registro", "uno o mas contactos")
        if 2 * s.sin_campos > s.filas:
            raise Unreadable(f"{s.sin_campos} de los {s.filas} contactos no traen ningun campo", "datos en la mitad o mas")

    def leads(self):
        used = {k for k, _ in self.found.values()}
        extras = [(k, h) for k, h in enumerate(self.headers) if k not in used and py_fold(h)]
        for i, fields in self._records():
            if i > self.seen.linea_encabezado and not _blank(fields):
                at = lambda k: fields[k] if k < len(fields) else ""  # noqa: B023, E731
                yield (self.seen.archivo, i, *[at(self.found[c][0]) for c in CANONICAL], {h: at(k) for k, h in extras})


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.verdicts = options["path"], options["verdicts"] == "true"
        self.mapping, self.synonyms = json.loads(options["mapping"]), json.loads(options["synonyms"])

    def partitions(self):
        return [InputPartition(p) for p in list_files(self.path)] or [InputPartition(None)]

    def read(self, partition):
        if partition.value is None:
            return
        gate = _Gate(partition.value, self.mapping, self.synonyms)
        seen = gate.judge()
        if self.verdicts:
            yield tuple(asdict(seen).values())
        elif seen.estado == "ENTRA":
            yield from gate.leads()


class FolderSource(DataSource):
    """Contacts of a folder of files, or with `verdicts` one row of findings a file."""

    @classmethod
    def name(cls):
        return "tamiz_folder"

    def schema(self):
        return _VERDICTS if self.options["verdicts"] == "true" else _LEADS

    def reader(self, schema):
        return _Reader(self.options)


def read_folder(spark: SparkSession, path: str, mapping: dict | None = None, synonyms: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(`archivo, registro`, the six lead columns, `extras`; one row of findings a file) of a folder or glob of delimited files.

    A file that the gate refuses gives no contacts and a row with `estado` NO ENTRA and its reason; the others are
    not held up by it. Short records are padded, blank ones left out and counted. An empty folder gives no rows. Paths may be URIs.
    """
    spark.dataSource.register(FolderSource)
    base = spark.read.format("tamiz_folder").option("mapping", json.dumps(check_mapping(mapping))).option("synonyms", json.dumps(synonyms))
    return base.option("verdicts", "false").load(path), base.option("verdicts", "true").load(path)


def numbered(leads: DataFrame) -> DataFrame:
    """`id_fila`: the position over all files, by file and record, for the plans."""
    from tamiz.operators.order import with_position

    return with_position(leads, [F.col("archivo").asc(), F.col("registro").asc()], "id_fila")
