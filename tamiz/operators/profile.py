"""Column-level quality profile of large tables and distribution changes between loads.

Everything derives from one mergeable base, the counts of each value by load and column:
counts of two batches add up, and so do the power sums made of them, so a profile can be
kept per batch and merged later without reading a row again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tamiz.session import cut, small_side

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Types whose order isn't that of their text.
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
_BIG = "decimal(38,0)"


def value_counts(df: DataFrame, load: str, columns: list[str]) -> DataFrame:
    """`carga, columna, valor, n`: how often each value occurs, by load and column.

    Values are compared as text; null stays null, empty stays empty. The counts are combined before
    the shuffle, so a value that fills a third of the table costs one row per task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"`{c}`").cast("string").alias("valor")) for c in columns])
    long = df.select(F.col(f"`{load}`").alias("carga"), F.inline(pairs))
    return long.groupBy("carga", "columna", "valor").agg(F.count(F.lit(1)).alias("n"))


def merge_counts(*batches: DataFrame) -> DataFrame:
    """Counts of several batches as if they had been read together."""
    return reduce(DataFrame.unionByName, batches).groupBy("carga", "columna", "valor").agg(F.sum("n").alias("n"))


def column_profile(counts: DataFrame, patterns: dict[str, str] | None = None, by_load: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """`[carga,] columna, filas, nulos, vacios, distintos, minimo, maximo, violaciones`.

    Distincts are exact and without null; ranges follow the order of the column's type in `schema`, that of the counted
    table, and are rendered as text (columns of text, and those not in `schema`, in the order of the text); `violaciones`
    counts non-empty values that don't match the column's whole-value pattern (null for a column without one).
    """
    v, n = F.col("valor"), F.col("n")
    hits = F.lit(None).cast("bigint")
    for name, pattern in (patterns or {}).items():
        miss = F.when((v != "") & ~v.rlike(_whole(pattern)), n).otherwise(0)
        hits = F.when(F.col("columna") == name, miss).otherwise(hits)
    typed: dict[str, list[str]] = {}
    for f in schema or ():
        if isinstance(f.dataType, _ORDERED):
            typed.setdefault(f.dataType.simpleString(), []).append(f.name)
    of = [F.when(F.col("columna").isin(names), v.try_cast(kind)) for kind, names in typed.items()]
    text = F.when(~F.col("columna").isin([c for names in typed.values() for c in names]), v) if typed else v
    extreme = lambda f: F.coalesce(*[f(x).cast("string") for x in (text, *of)])
    keys = ["carga", "columna"] if by_load else ["columna"]
    if not by_load:
        counts = counts.groupBy("columna", "valor").agg(F.sum("n").alias("n"))
    return counts.groupBy(*keys).agg(
        F.sum("n").alias("filas"),
        F.sum(F.when(v.isNull(), n).otherwise(0)).alias("nulos"),
        F.sum(F.when(v == "", n).otherwise(0)).alias("vacios"),
        F.count("valor").alias("distintos"),
        extreme(F.min).alias("minimo"),
        extreme(F.max).alias("maximo"),
        F.sum(hits).alias("violaciones"),
    )


def power_sums(counts: DataFrame) -> DataFrame:
    """`carga, columna, s0..s4`: exact sums of the powers of whole-number values (others are left out).

    Sums are DECIMAL(38,0), never floating point, so any order of merging gives the same digits;
    a sum beyond 38 digits becomes null instead of wrong.
    """
    x = F.col("valor").try_cast("bigint").cast(_BIG)
    n = F.col("n").cast(_BIG)
    powers = [n]
    for _ in range(4):
        powers.append(F.try_multiply(powers[-1], x).try_cast(_BIG))
    rows = counts.where(F.col("valor").try_cast("bigint").isNotNull() & F.col("valor").rlike(r"\A-?[0-9]+\z"))
    return rows.groupBy("carga", "columna").agg(*[F.try_sum(p).try_cast(_BIG).alias(f"s{i}") for i, p in enumerate(powers)])


def merge_power_sums(*batches: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, batches).groupBy("carga", "columna").agg(*[F.try_sum(f"s{i}").try_cast(_BIG).alias(f"s{i}") for i in range(5)])


def _difference(s: list[Column], t: list[Column]) -> tuple[Column, Column, Column, Column]:
    """(mean, deviation, mean of the rest, standardised difference) from sums s0, s1, s2 of a part and t0, t1, t2 of the whole.

    The rest's sums are the whole's minus the part's own, so no pair of parts is formed. The difference of means is
    divided by the root of the mean of the two variances; null when both don't vary.
    """
    d = lambda c: c.cast("double")
    n, m = d(s[0]), F.nullif(d(t[0] - s[0]), F.lit(0.0))
    mean, rest = d(s[1]) / n, d(t[1] - s[1]) / m
    var = F.greatest(d(s[2]) / n - mean * mean, F.lit(0.0))
    var_rest = F.greatest(d(t[2] - s[2]) / m - rest * rest, F.lit(0.0))
    return mean, F.sqrt(var), rest, (mean - rest) / F.nullif(F.sqrt((var + var_rest) / 2), F.lit(0.0))


def standardised_differences(sums: DataFrame) -> DataFrame:
    """`carga, columna, media, desvio, media_resto, diferencia`: each load against all other loads together."""
    total = sums.groupBy("columna").agg(*[F.sum(f"s{i}").cast(_BIG).alias(f"t{i}") for i in range(3)])
    mean, deviation, rest, difference = _difference(*[[F.col(f"{x}{i}") for i in range(3)] for x in "st"])
    return sums.join(total, "columna").select("carga", "columna", mean.alias("media"), deviation.alias("desvio"), rest.alias("media_resto"), difference.alias("diferencia"))


def share_shifts(counts: DataFrame, threshold: float, max_loads: int = 100_000) -> DataFrame:
    """`carga, columna, valor, parte, mediana, diferencia`: loads in which the share of a value is further than `threshold`
    from the median of that share over all loads; a load without the value has share 0, null counts as ''.

    The power sums of a value's indicator are the load's rows and, as first and second sum, the rows with the value; from them come
    the share, as mean, and its standardised difference to the other loads. The median rule is the exact test on these means. Medians
    are taken by rank, not by collecting a group. Only values whose median exceeds the threshold, fewer than
    two over the threshold per column, are looked up in the loads that lack them. Rows without a load are left out.
    """
    known = counts.where(F.col("carga").isNotNull()).withColumn("valor", F.coalesce("valor", F.lit("")))
    known = cut(known.groupBy("carga", "columna", "valor").agg(F.sum("n").alias("n")))
    totals = cut(known.groupBy("columna", "carga").agg(F.sum("n").alias("total")))
    whole = totals.groupBy("columna").agg(F.sum("total").alias("t0"))
    loads = totals.select("carga").distinct().count()
    side = small_side(totals.join(whole, "columna"), max_loads)
    w = Window.partitionBy("columna", "valor")
    sums = known.join(side, ["columna", "carga"]).withColumn("t1", F.sum("n").over(w))
    mean, _, _, difference = _difference([F.col("total"), F.col("n"), F.col("n")], [F.col("t0"), F.col("t1"), F.col("t1")])
    shares = cut(sums.select("columna", "carga", "valor", mean.alias("parte"), difference.alias("diferencia"), "t1"))
    ranked = shares.select("columna", "valor", "parte", "t1", F.row_number().over(w.orderBy("parte")).alias("r"), F.count(F.lit(1)).over(w).alias("k"))
    place = F.col("r") + F.lit(loads) - F.col("k")
    low, high = (loads + 1) // 2, (loads + 2) // 2
    half = lambda p: F.sum(F.when(place == p, F.col("parte")).otherwise(0.0))
    medians = ranked.groupBy("columna", "valor").agg(((half(low) + half(high)) / 2).alias("mediana"), F.max("t1").alias("t1"))
    apart = F.round(F.abs(F.col("parte") - F.col("mediana")), 12) > threshold
    present = shares.join(medians.drop("t1"), ["columna", "valor"]).where(apart)
    common = medians.where(F.col("mediana") > threshold)
    none = F.lit(0).cast("bigint")
    mean, _, _, difference = _difference([F.col("total"), none, none], [F.col("t0"), F.col("t1"), F.col("t1")])
    lacking = side.join(small_side(common, max_loads), "columna").join(shares, ["columna", "carga", "valor"], "left_anti").withColumns({"parte": mean, "diferencia": difference}).where(apart)
    cols = ["carga", "columna", "valor", "parte", "mediana", "diferencia"]
    return present.select(*cols).unionByName(lacking.select(*cols))


def _whole(pattern: str) -> str:
    return rf"\A(?:{pattern})\z"


def violations(counts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """`columna, valor, n`: the non-empty values that don't match their column's whole-value pattern, and how often they occur."""
    bad = F.lit(False)
    for name, pattern in patterns.items():
        bad = bad | ((F.col("columna") == name) & (F.col("valor") != "") & ~F.col("valor").rlike(_whole(pattern)))
    return counts.where(bad).groupBy("columna", "valor").agg(F.sum("n").alias("n"))


def violating_rows(df: DataFrame, key: str, bad: DataFrame, columns: list[str], max_values: int = 1_000_000) -> DataFrame:
    """`columna, clave`: the rows that hold one of the violations. Distinct bad values are few beside the rows; they are
    broadcast if measured small, else joined by value, and a row is read once."""
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"`{c}`").cast("string").alias("valor")) for c in columns])
    cells = df.select(F.col(key).cast("bigint").alias("clave"), F.inline(pairs)).where("valor <> ''")
    return cells.join(small_side(bad.select("columna", "valor"), max_values), ["columna", "valor"]).select("columna", "clave")


def wide_profile(df: DataFrame, load: str, columns: list[str], patterns: dict[str, str] | None = None) -> DataFrame:
    """The profile of columns with too many values to count each: as `column_profile` by load, in one aggregate.

    Only a 128-bit digest of each value is shuffled to count distincts; all else is combined where the rows lie.
    """
    patterns = patterns or {}
    kinds = {f.name: f.dataType for f in df.schema}
    named = lambda c, x: x.alias(f"{columns.index(c)}_{c}")
    facts = []
    for c in columns:
        v, text = F.col(f"`{c}`"), F.col(f"`{c}`").cast("string")
        ranged = v if isinstance(kinds[c], _ORDERED) else text
        miss = F.count_if((text != "") & ~text.rlike(_whole(patterns[c]))) if c in patterns else F.lit(None).cast("bigint")
        facts.append(named(c, F.struct(
            F.count(F.lit(1)).alias("filas"), F.count_if(v.isNull()).alias("nulos"), F.count_if(text == "").alias("vacios"),
            F.min(ranged).cast("string").alias("minimo"), F.max(ranged).cast("string").alias("maximo"), miss.alias("violaciones"),
        )))
    one = df.groupBy(F.col(f"`{load}`").alias("carga")).agg(*facts)
    rows = one.select("carga", F.inline(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"`{columns.index(c)}_{c}`").alias("f")) for c in columns]))).select("carga", "columna", "f.*")
    digest = lambda c: F.struct(F.lit(c).alias("columna"), F.when(F.col(f"`{c}`").isNotNull(), F.unhex(F.md5(F.col(f"`{c}`").cast("string").cast("binary")))).alias("d"))
    cells = df.select(F.col(f"`{load}`").alias("carga"), F.inline(F.array(*map(digest, columns)))).where("d is not null").distinct()
    distinct = cells.groupBy(F.col("carga").alias("__l"), F.col("columna").alias("__c")).agg(F.count(F.lit(1)).alias("distintos"))
    joined = rows.join(distinct, F.col("carga").eqNullSafe(F.col("__l")) & (F.col("columna") == F.col("__c")), "left")
    return joined.select("carga", "columna", "filas", "nulos", "vacios", F.coalesce("distintos", F.lit(0)).alias("distintos"), "minimo", "maximo", "violaciones")


def full_profile(df: DataFrame, load: str, patterns: dict[str, str] | None = None, narrow: float = 0.01) -> DataFrame:
    """The profile of every column by load. Columns with distinct values for at most `narrow` of the rows, as estimated in
    one pass, are profiled from their mergeable counts, the others directly; the result is the same."""
    columns = [c for c in df.columns if c != load]
    if not columns:
        raise ValueError("no columns beside the load")
    seen = df.agg(F.count(F.lit(1)).alias("__n"), *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"{i}") for i, c in enumerate(columns)]).first()
    wide = [c for i, c in enumerate(columns) if seen[str(i)] > narrow * seen["__n"]]
    few = [c for c in columns if c not in wide]
    parts = [column_profile(value_counts(df, load, few), patterns, schema=df.schema)] if few else []
    parts += [wide_profile(df, load, wide, patterns)] if wide else []
    return reduce(DataFrame.unionByName, parts)


# The enumerations of the profiled columns.
ALLOWED = {"telefono_tipo": ("celular", "fijo", "ambiguo", "invalido"), "cuil_valido": ("TRUE", "FALSE"), "en_zona": ("TRUE", "FALSE")}
SHARE_CHANGE = 0.21


#: Whole-value patterns of salida_adv1.
PATTERNS = {k: "|".join(v) for k, v in ALLOWED.items()} | {"cuil_norm": "[0-9]{11}"}


def found(spark, sf_dir: str) -> DataFrame:
    """Problem 6: stray values by row, odd loads by column; both from the same counts of values by load."""
    t = spark.read.parquet(f"{sf_dir}/salida_adv1.parquet")
    columns = list(ALLOWED)
    counts = cut(value_counts(t, "carga_id", columns))
    bad = violations(counts, {c: PATTERNS[c] for c in columns})
    stray = violating_rows(t, "id_fila", bad, columns).select("columna", F.lit("patron").alias("hallazgo"), "clave")
    odd = share_shifts(counts, SHARE_CHANGE).select("columna", F.lit("cambio").alias("hallazgo"), F.col("carga").cast("bigint").alias("clave")).distinct()
    return stray.unionByName(odd)


def table_profile(spark, sf_dir: str) -> DataFrame:
    """The profile of every column of salida_adv1 by load."""
    return full_profile(spark.read.parquet(f"{sf_dir}/salida_adv1.parquet"), "carga_id", PATTERNS)


def numeric_shifts(spark, sf_dir: str) -> DataFrame:
    """Standardised differences of the whole-number columns of salida_adv1 between loads."""
    t = spark.read.parquet(f"{sf_dir}/salida_adv1.parquet")
    sums = power_sums(value_counts(t, "carga_id", ["puntaje", "dias_antiguedad"]))
    out = standardised_differences(sums)
    return out.select("carga", "columna", *[F.round(c, 6).alias(c) for c in ("media", "desvio", "media_resto", "diferencia")])
