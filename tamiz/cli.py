"""python -m tamiz.cli FILE [options]: gate, plan, sinks and the numbers. Exit 0 done, 1 rejected, 2 wrong use (U4, K7)."""

from __future__ import annotations

import argparse
import shutil
import sys
from pathlib import Path

from pyspark.sql import functions as F

from tamiz.functions.dates import resolve_cutoff
from tamiz.operators import report
from tamiz.operators.rules import optout_sets
from tamiz.plans.config import ConfigError, Filler, OptOut, PlanConfig, Segment, filler_from, read_json, segment_from
from tamiz.plans.pipeline import COMMERCIAL, PLANS, audit_columns, build, ranked
from tamiz.session import build_session
from tamiz.sources.gate import RejectedFile, read_leads, read_optout, whole_lists
from tamiz.sources.folder import numbered, read_folder
from tamiz.sources.sinks import write_csv, write_partitioned_csv, write_text


def main(argv: list[str] | None = None) -> int:
    a = argparse.ArgumentParser(prog="tamiz")
    a.add_argument("archivo")
    a.add_argument("--mapeo", help="JSON: client header to canonical column")
    a.add_argument("--baja", help="do-not-call list")
    a.add_argument("--segmentacion", help="JSON: person type label and discard")
    a.add_argument("--basura", help="JSON: filler phones and names")
    a.add_argument("--fecha-corte")
    a.add_argument("--salida-dir", default="salidas")
    a.add_argument("--fase", default="14", choices=PLANS)
    a.add_argument("--particionado", action="store_true", help="tables as folders of part files, written by the executors; always so for a folder of files")
    try:
        o = a.parse_args(argv)
    except SystemExit as e:
        return 0 if e.code == 0 else 2
    if "://" not in o.archivo and not Path(o.archivo).exists():
        print(f"no existe: {o.archivo}", file=sys.stderr)
        return 2
    try:
        config = PlanConfig(
            cutoff=resolve_cutoff(o.fecha_corte)[1], filler=filler_from(o.basura) if o.basura else Filler(), segment=segment_from(o.segmentacion) if o.segmentacion else Segment(), optout=OptOut()
        )
        mapping = read_json(o.mapeo) if o.mapeo else None
    except (ConfigError, ValueError, OSError) as e:
        print(e, file=sys.stderr)
        return 2
    out, stem = Path(o.salida_dir), Path(o.archivo.rstrip("/")).stem
    out.mkdir(parents=True, exist_ok=True)
    paths = {k: out / f"{k}_{stem}.{'csv' if k in ('comercial', 'auditoria') else 'md'}" for k in ("comercial", "auditoria", "reporte", "ficha_entrada")}
    for p in paths.values():
        p.unlink(missing_ok=True)
        shutil.rmtree(p.with_suffix(""), ignore_errors=True)
    shutil.rmtree(whole_lists(str(paths["ficha_entrada"])), ignore_errors=True)
    spark = build_session()
    try:
        folder = "://" not in o.archivo and Path(o.archivo).is_dir()
        if folder:
            leads, verdicts = read_folder(spark, o.archivo, mapping)
            verdicts.orderBy("archivo").write.mode("overwrite").json(str(paths["ficha_entrada"].with_suffix("")))
            leads = numbered(leads.withColumn("extra_archivo", F.col("archivo")).withColumn("extra_columnas", F.when(F.size("extras") > 0, F.to_json("extras")).otherwise("")))
        else:
            leads, _ = read_leads(spark, o.archivo, mapping, on_profile=lambda p: p.write(str(paths["ficha_entrada"])))
        sets = optout_sets(read_optout(spark, o.baja))[:2] if o.baja else None
        def write(df, columns, path: Path) -> None:
            if o.particionado or folder:
                write_partitioned_csv(df, columns, str(path.with_suffix("")))
            else:
                write_csv(df, columns, str(path))

        done = build(leads, o.fase, config, sets)
        if int(o.fase) < 6:
            write(done.orderBy("id_fila"), done.columns, paths["auditoria"])
            return 0
        # One table serves both sinks and the numbers.
        ordered = ranked(done).persist()
        write(ordered, list(COMMERCIAL), paths["comercial"])
        write(ordered, audit_columns(done), paths["auditoria"])
        m = report.metrics(ordered).first().asDict()
        ordered.unpersist()
        write_text(report.render(m, config.cutoff), str(paths["reporte"]))
    except (RejectedFile, ConfigError) as e:
        print(e, file=sys.stderr)
        return 1
    d = report.derived(m)
    for p in paths.values():
        print(p)
    print(f"contactos: {m['total']}  llamables: {d['llamables']}  descartados: {m['descartado']}  horas: {d['horas']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
