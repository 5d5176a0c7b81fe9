"""Leads that arrive as a stream: narrow steps on the stream, the whole plan over what is stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tamiz.functions.phone import with_phone
from tamiz.functions.taxid import with_taxid
from tamiz.operators.rules import with_coverage
from tamiz.plans.config import PlanConfig
from tamiz.plans.pipeline import build, with_age


def canonical_stream(leads: DataFrame, config: PlanConfig | None = None) -> DataFrame:
    """Phone, tax id, coverage and age of a stream of leads. No state, no watermark; rows in are rows out."""
    c = config or PlanConfig()
    return with_age(with_coverage(with_taxid(with_phone(leads, "telefono"), "cuil"), c.zone), c.cutoff)


def recompute_each_batch(store: str, sink: Callable[[DataFrame, int], None], config: PlanConfig | None = None) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: appends the batch to the parquet folder `store` and hands `sink` the plan over all of it.

    A batch that is run again replaces its own part, so retries don't double rows. `id_fila` must be unique over all batches.
    """

    def run(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store}/lote={number}")
        whole = batch.sparkSession.read.parquet(store).drop("lote")
        sink(build(whole, "08", config), number)

    return run
