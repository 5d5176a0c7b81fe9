"""Texts that lost their end: cut inside a word or a sentence, and each source's rate of them.

Only texts without a closing stop are in question. Their last token is looked up in the corpus vocabulary trie, their
last words in the corpus' counts of how often such words end a sentence, and their length in
their source's lengths, where a field limit shows as a spike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.llm import words as W
from tamiz.session import cut, small_side

#: Longest run of last words that is looked up, least count that says something, most share of sentence ends in a cut.
CONTEXT, ENOUGH, RARE_END = 5, 20, 0.02
#: A last token seen fewer than ENOUGH times is a stump if the words that go on with it are together so many times as frequent.
STUMP_TIMES = 100
#: A field limit: so unlikely (natural logarithm) by the lengths around it, so many times as frequent as these, this share of the source's open texts.
LIMIT_NATS, LIMIT_TIMES, LIMIT_SHARE, LIMIT_AROUND = 10.0, 8, 0.02, 10
#: The looked-up side is broadcast up to this many rows (about 20 bytes each), else joined by shuffle.
MAX_BROADCAST_ROWS = 1_000_000

#: White space, runs of dots and invisible marks at the end of a text, read backwards; runs of dots alone.
_TAIL = re.compile("(?:[ \\t\\n\\x0b\\f\\r]|\\.{2,}|…|[\u200B-\u200F\u2060\uFEFF])+")
_DOTS = re.compile("(?:\\.{2,}|…)+")
_CLOSE, _STOPS = "»”\"')]", ".?!"
_DANGLING = r"(?:[,;:(\[¿¡]|\uFFFD)\z"
#: A short note or sign set behind a finished sentence.
_NOTE = r"[.?!] +(?:[^a-zA-Z0-9À-ɏ\s¿¡][^\n]{0,24}|(?=[^\n]{1,24}\z)[^\n]*[\p{S}\p{No}][^\n]*)\z"


def _ending(text: str) -> tuple[str, str, bool]:
    """(text without its tail, text without trailing dots, whether it lacks a closing stop)."""
    back = text[::-1]
    tail, dots = _TAIL.match(back), _DOTS.match(back)
    bare, kept = (text[: len(text) - m.end()] if m else text for m in (tail, dots))
    return bare, kept, not bare.rstrip(_CLOSE).endswith(tuple(_STOPS))


def _tokens(texts) -> W.Words:
    """Folded words, numbers as 0, sentence borders as |."""
    import pyarrow.compute as pc

    t = pc.replace_substring_regex(W.lowered(texts), r"[.?!]+([\s\x0b»”\"')\]]|\z)", r" | \1")
    return W.split_words(pc.replace_substring_regex(t, r"\n+", " | "), "[^a-z0-9|]+", number="0")


def _grams(w: W.Words):
    """For k = 1 to CONTEXT: (hash of the k tokens that end at each place, whether they lie within one sentence of one text);
    beside them which tokens are borders."""
    import numpy as np

    n = len(w.code)
    at = np.arange(n)
    border = np.array([x == "|" for x in w.vocabulary], bool)[w.index] if n else np.zeros(0, bool)
    last = np.where(border, at, -1)
    first = w.start[w.size > 0]
    last[first] = np.maximum(last[first], first - 1)
    inside = at - np.maximum.accumulate(last)
    out, h = [], np.zeros(n, np.uint64)
    for k in range(1, CONTEXT + 1):
        h = h.copy()
        h[k - 1 :] += w.code[: n - k + 1] * np.uint64(W.power(k - 1))
        out.append((W.mixed(h, k), inside >= k))
    return out, border


def open_texts(docs: DataFrame) -> DataFrame:
    """`doc_id, source, bare, chars, bytes, last, grams` of the texts without a closing stop: the text without trailing
    marks, its size without trailing dots (a cut may fall behind a blank), its last token, hashes of its last 1 to CONTEXT tokens."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "source")}

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in W.slices(batch, "text"):
                ends = [(i, *_ending(t)) for i, t in enumerate(part.column("text").to_pylist()) if t]
                ends = [(i, bare, kept) for i, bare, kept, is_open in ends if bare and is_open]
                rows = pa.array([i for i, *_ in ends], pa.int64())
                bare = pa.array([b for _, b, _ in ends], pa.string())
                w = _tokens(bare)
                grams, border = _grams(w)
                at = w.start + w.size - 1
                some = (w.size > 0) & ~border[at] if len(border) else np.zeros(len(ends), bool)
                last = [w.vocabulary[w.index[i]] if ok else None for i, ok in zip(at, some)]
                lists = [[int(h[i].view(np.int64)) if ok and whole[i] else None for h, whole in grams] for i, ok in zip(at, some)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).take(rows) for c in kinds], bare, pa.array([len(k) for *_, k in ends], pa.int32()), pa.array([len(k.encode("utf-8", "surrogatepass")) for *_, k in ends], pa.int32()),
                        pa.array(last, pa.string()), pa.array(lists, pa.list_(pa.int64())),
                    ],
                    [*kinds, "bare", "chars", "bytes", "last", "grams"],
                )

    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", bare string, chars int, bytes int, last string, grams array<bigint>"
    return docs.select("doc_id", "source", "text").mapInArrow(read, schema)


def corpus_counts(docs: DataFrame, asked) -> DataFrame:
    """`g, w, n, e`: in one pass over all texts, how often each gram that may be among the asked (a broadcast bit filter)
    occurs and ends a sentence (`w` null), and how often each word occurs (`g` null), combined per slice of a batch.

    The last token of an open text is in question itself and not counted.
    """

    def read(batches):
        import numpy as np
        import pyarrow as pa

        names = ["g", "w", "n", "e"]
        for batch in batches:
            for part in W.slices(batch, "text"):
                ends = [_ending(t or "") for t in part.column("text").to_pylist()]
                w = _tokens(pa.array([bare for bare, _, _ in ends], pa.string()))
                grams, border = _grams(w)
                n = len(w.code)
                stop = np.ones(n, bool)
                stop[: n - 1] = border[1:]
                stop[(w.start + w.size - 1)[w.size > 0]] = True
                counted = ~border
                counted[(w.start + w.size - 1)[(w.size > 0) & np.array([o for *_, o in ends], bool)]] = False
                for h, whole in grams:
                    keep = counted & whole
                    keep[keep] = W.passes(asked.value, h[keep])
                    g, place = np.unique(h[keep], return_inverse=True)
                    e = np.bincount(place, stop[keep], len(g)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.nulls(len(g), pa.string()), pa.array(np.bincount(place, minlength=len(g)).astype(np.int64)), pa.array(e)], names)
                m = np.bincount(w.index[counted], minlength=len(w.vocabulary)).astype(np.int64)
                seen = pa.array(w.vocabulary, pa.string()).filter(pa.array(m > 0))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(seen), pa.int64()), seen, pa.array(m[m > 0]), pa.nulls(len(seen), pa.int64())], names)

    return docs.select("text").mapInArrow(read, "g bigint, w string, n bigint, e bigint")


def field_limits(open_docs: DataFrame) -> DataFrame:
    """`source, medida, largo`: lengths, in characters (c) and UTF-8 bytes (b), at which a source cuts.

    A length is a limit if so many texts of just this length are that unlikely beside the lengths around it: the
    log-likelihood of the Poisson surplus is at least LIMIT_NATS, and they are LIMIT_SHARE of the source's open texts.
    """
    sizes = F.array(F.struct(F.lit("c").alias("medida"), F.col("chars").alias("largo")), F.struct(F.lit("b").alias("medida"), F.col("bytes").alias("largo")))
    counts = open_docs.select("source", F.inline(sizes)).groupBy("source", "medida", "largo").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("source", "medida")
    near = F.sum("n").over(by.orderBy("largo").rangeBetween(-LIMIT_AROUND, LIMIT_AROUND)) - F.col("n")
    usual = F.col("near") / (2 * LIMIT_AROUND) + 0.25
    seen = counts.withColumn("near", near).withColumn("total", F.sum("n").over(by)).withColumn("usual", usual)
    surplus = F.col("n") * F.log(F.col("n") / F.col("usual")) - (F.col("n") - F.col("usual"))
    return seen.where((F.col("n") > LIMIT_TIMES * F.col("usual")) & (surplus >= LIMIT_NATS) & (F.col("n") >= LIMIT_SHARE * F.col("total"))).select("source", "medida", "largo")


def truncated(docs: DataFrame, max_broadcast: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`doc_id, source, motivo` of the rows of `docs(doc_id, source, text)` whose text lost its end.

    `motivo` is the first that holds: `limite` (its length is a limit of its source), `colgada` (ends in a comma, colon,
    opening sign, speaker's label or half a character), `palabra` (the last token is a proper prefix of words of the corpus and
    either no word itself, or a rare one that never ends a sentence beside words that are far more frequent), `frase` (its last words, as many as are known often enough, hardly ever end a sentence). Trailing dots and white
    space don't count, nor a short note behind a finished sentence. Null, empty and blank texts and texts with a
    closing stop are never cut. Counts are of all documents; repeated rows keep their own rows; a null source is its own source.
    Two passes over the texts: the ends of the open ones, then the counts of their last words in all.
    """
    asked = open_texts(docs).withColumns({"note": F.col("bare").rlike(_NOTE), "dangling": F.col("bare").rlike(_DANGLING)}).drop("bare")
    asked = cut(asked.withColumn("row", F.monotonically_increasing_id()))
    limits = cut(field_limits(asked))
    at = lambda m, c: small_side(limits.where(F.col("medida") == m).select(F.col("source").alias("__s"), F.col("largo").alias("__n"), F.lit(True).alias(c)), max_broadcast)
    base = asked.select("row", "source", "chars", "bytes")
    near = base.join(at("c", "lc"), F.col("source").eqNullSafe(F.col("__s")) & (F.col("chars") == F.col("__n")), "left").drop("__s", "__n")
    near = near.join(at("b", "lb"), F.col("source").eqNullSafe(F.col("__s")) & (F.col("bytes") == F.col("__n")), "left")
    near = near.select("row", F.coalesce("lc", "lb", F.lit(False)).alias("limit"))

    # How often the last words occur, and end a sentence, anywhere else in the corpus.
    wanted = cut(asked.select(F.explode("grams").alias("g")).where("g is not null").distinct())
    side = F.broadcast if wanted.limit(max_broadcast + 1).count() <= max_broadcast else (lambda x: x)
    seen = corpus_counts(docs, W.bit_filter(wanted, "g"))
    seen = cut(seen.groupBy("g", "w").agg(F.sum("n").alias("n"), F.sum("e").alias("e")))
    counts = cut(seen.where("g is not null").join(side(wanted), "g").select("g", "n", "e"))

    # The vocabulary as a trie: a proper prefix of a distinct word is a node, with the counts of the words below it.
    # Only last tokens that are unknown, or rare and never at a sentence's end, are walked, at the depths such tokens have.
    unknown = asked.select("last", F.get("grams", F.lit(0)).alias("g")).where("last is not null and last <> '0'").distinct()
    unknown = unknown.join(side(counts), "g", "left").na.fill(0, ["n", "e"]).where((F.col("n") < ENOUGH) & (F.col("e") == 0))
    unknown = cut(unknown.select("last", F.col("n").alias("own")))
    depths = [r[0] for r in unknown.select(F.length("last")).distinct().collect()]
    below = seen.where("w is not null").select("n", F.explode(F.array(*[F.when(F.length("w") > d, F.substring("w", 1, d)) for d in depths]) if depths else F.array().cast("array<string>")).alias("last"))
    below = below.where("last is not null").join(side(unknown), "last").groupBy("last", "own").agg(F.sum("n").alias("n"))
    stems = below.where(F.col("n") >= STUMP_TIMES * F.col("own")).select("last", F.lit(True).alias("stem"))

    levels = asked.select("row", F.posexplode("grams").alias("k", "g")).where("g is not null").join(side(counts), "g").where(F.col("n") >= ENOUGH)
    longest = levels.groupBy("row").agg(F.max_by(F.col("e") / F.col("n"), "k").alias("p"))
    joined = asked.drop("grams").join(near, "row").join(longest, "row", "left").join(side(stems), "last", "left")
    why = (
        F.when(F.col("note") & ~F.col("limit"), F.lit(None))
        .when(F.col("limit"), "limite")
        .when(F.col("dangling"), "colgada")
        .when(F.col("stem"), "palabra")
        .when(F.col("last").isNotNull() & (F.col("p") < RARE_END), "frase")
    )
    return joined.select("doc_id", "source", why.alias("motivo")).where("motivo is not null")


def found(spark, sf_dir: str) -> DataFrame:
    """Problem 10: documents whose text lost its end."""
    return truncated(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "source")


def rates(spark, sf_dir: str) -> DataFrame:
    """`source, textos, cortados, tasa`: each source's texts, truncated texts and their share."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cuts = truncated(docs).groupBy("source").agg(F.count(F.lit(1)).alias("cortados"))
    texts = docs.where("text is not null").groupBy("source").agg(F.count(F.lit(1)).alias("textos"))
    out = texts.join(cuts.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")), "left")
    cut_n = F.coalesce("cortados", F.lit(0))
    return out.select("source", "textos", cut_n.alias("cortados"), F.round(cut_n / F.col("textos"), 6).alias("tasa"))
