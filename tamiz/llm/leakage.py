"""Passages of held-out items inside the corpus.

A document holds a run of `size` consecutive words of an item exactly if it holds all shingles of that run, so the rarest
one is a necessary prefix. Shingles are ordered by their frequency over all documents, windows join by their
rarest shingle, positions and lengths bound the place, and the words of the item-sized window are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.functions.text import strip_marks
from tamiz.llm import words as W
from tamiz.session import cut

#: Consecutive words that make a leak; words in a shingle.
RUN_WORDS, SHINGLE_WORDS = 13, 5
#: The items' side is broadcast up to this many rows (about 200 bytes each), else joined by shuffle.
MAX_BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Runs of a-z and 0-9 after removing diacritics and lower-casing; null and empty texts have none."""
    flat = F.regexp_replace(F.lower(strip_marks(F.coalesce(text, F.lit("")))), "[^a-z0-9 ]+", " ")
    # Single blanks stay as they are: replacing each would cost more than all the rest.
    return F.filter(F.split(flat, " "), lambda w: w != "")


def shingles(rows: DataFrame, key: str, text: str, run: int, k: int, asked=None) -> DataFrame:
    """`key, pos, h, n`: place and hash of every k-word shingle of texts with at least `run` words, and the text's words.

    With `asked`, a broadcast bit filter, only shingles that may be among the asked come out. One pass over the texts.
    """
    kind = rows.schema[key].dataType.simpleString()

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in W.slices(batch, text):
                w = W.split_words(W.lowered(part.column(text)))
                h = W.runs(w.code, k)
                row = np.repeat(np.arange(len(w.size)), w.size)[: len(h)]
                pos = np.arange(len(h)) - w.start[row]
                keep = (pos + k <= w.size[row]) & (w.size[row] >= run)
                if asked is not None:
                    keep &= W.passes(asked.value, h)
                row = row[keep]
                columns = [part.column(key).take(pa.array(row)), pa.array(pos[keep].astype(np.int32)), pa.array(h[keep].view(np.int64)), pa.array(w.size[row].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [key, "pos", "h", "n"])

    return rows.select(key, text).mapInArrow(read, f"`{key}` {kind}, pos int, h bigint, n int")


def leaks(docs: DataFrame, items: DataFrame, run: int = RUN_WORDS, k: int = SHINGLE_WORDS, max_broadcast: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`doc_id, item_id`: documents of `docs(doc_id, text)` with at least `run` consecutive words of an item of `items(item_id, text)`.

    Pairs are distinct. Items and documents shorter than `run` words, null and empty texts give nothing; whole texts are
    read; equal texts each get their rows; null ids stay, as one document or item each. The corpus is shingled once, keeping
    only shingles that items have, and only documents with a complete prefix match are read again. The items' side
    is counted: up to `max_broadcast` rows it is broadcast, beyond that the same joins shuffle on the shingle.
    """
    if not 0 < k <= run:
        raise ValueError("0 < k <= run")
    w = items.select("item_id", words(F.col("text")).alias("w"))
    starts = F.when(F.size("w") >= run, F.sequence(F.lit(0), F.size("w") - run)).otherwise(F.array().cast("array<int>"))
    windows = cut(w.select("item_id", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i + 1, run), " "))).alias("win")).distinct())
    # Windows go by number from here on; their words come back for the comparison only.
    numbered = cut(windows.select("win").distinct().withColumn("wid", F.monotonically_increasing_id()))
    cand = cut(shingles(numbered, "wid", "win", run, k).select("wid", F.col("pos").alias("off"), "h"))
    known = cut(cand.select("h").distinct())
    small = cand.limit(max_broadcast + 1).count() <= max_broadcast
    side = F.broadcast if small else (lambda x: x)

    hits = cut(shingles(docs, "doc_id", "text", run, k, W.bit_filter(known, "h")).join(side(known), "h"))
    rarity = cut(hits.groupBy("h").agg(F.count(F.lit(1)).alias("df")))
    # A window with a shingle that no document has can't occur; of the others the rarest shingle is its prefix.
    order = Window.partitionBy("wid").orderBy("df", "h", "off")
    ranked = cand.join(side(rarity), "h", "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("__r", F.row_number().over(order))
    prefix = ranked.groupBy("wid").agg(F.min("df").alias("least"), F.min(F.when(F.col("__r") == 1, F.struct("h", "off"))).alias("p"))
    prefix = cut(prefix.where("least > 0").select("wid", "p.*"))
    near = hits.join(side(prefix), "h").where(f"pos >= off and pos - off + {run} <= n").select("doc_id", "wid").distinct()
    near = cut(near)
    few = F.broadcast if near.limit(max_broadcast + 1).count() <= max_broadcast else (lambda x: x)
    same = F.col("__d").eqNullSafe(F.col("doc_id"))
    asked = docs.join(few(near.select(F.col("doc_id").alias("__d")).distinct()), same, "left_semi").select("doc_id", F.concat(F.lit(" "), F.array_join(words(F.col("text")), " "), F.lit(" ")).alias("t"))
    found = asked.join(few(near.withColumnRenamed("doc_id", "__d").join(side(numbered), "wid")), same).where(F.contains("t", F.concat(F.lit(" "), "win", F.lit(" ")))).select("doc_id", "win").distinct()
    return found.join(side(windows), "win").select("doc_id", "item_id").distinct()


def found(spark, sf_dir: str) -> DataFrame:
    """Problem 9: documents that carry passages of the evaluation items."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/items_evaluacion.parquet"))
