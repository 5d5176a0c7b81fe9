"""Mixed timestamp spellings and zones brought to one UTC form.

An ordered cascade of anchored patterns rewrites a value into nine canonical fields;
strict range checks follow, the source's default zone comes from a lookup, and local
times that its clocks skip or show twice get a verdict instead of a guess.
Everything is built-in expressions: no UDF and no shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import WS, is_blank, strip_marks, trim_ws
from tamiz.session import once, small_side

UNREADABLE, SKIPPED, TWICE = "ilegible", "inexistente", "ambigua"
FINAL_DAY = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
FINAL_MOMENT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}Z\z"

# Month names by their first letters (Spanish, Portuguese, English), month number.
MONTHS = {
    "ene": 1, "jan": 1, "feb": 2, "fev": 2, "mar": 3, "abr": 4, "apr": 4, "may": 5, "mai": 5, "jun": 6, "jul": 7,
    "ago": 8, "aug": 8, "sep": 9, "set": 9, "oct": 10, "out": 10, "nov": 11, "dic": 12, "dez": 12, "dec": 12,
}
# Full month names of the three languages, without marks.
MONTH_NAMES = (
    "enero febrero marzo abril mayo junio julio agosto septiembre setiembre octubre noviembre diciembre "
    "janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro "
    "january february march april may june july august september october november december sept"
).split()
# Zone abbreviations, minutes east of UTC.
ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "z": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180,
    "art": -180, "brt": -180, "brst": -120, "uyt": -180, "uyst": -120, "clt": -240, "clst": -180, "pyt": -240, "pyst": -180,
    "bot": -240, "vet": -240, "pet": -300, "cot": -300, "ect": -300, "ast": -240, "adt": -180, "est": -300, "edt": -240,
    "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}

_MONTH = "(" + "|".join(sorted({*MONTHS, *MONTH_NAMES}, key=lambda x: (-len(x), x))) + ")"
_WEEKDAY = r"(?:[a-z]{3,9}\.?,? )?"
_CLOCK = r"(?:(?:t|,? |, ?)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?(?: ?([ap])\.? ?m(?![a-z])\.?)?(?: ?(?:hs|hrs|h)(?![a-z])\.?)?(?: ?(\S+))?)?"
_PACKED = r"(?:[t ]?([0-9]{2})([0-9]{2})(?:([0-9]{2})(?:[.,]([0-9]+))?)?()(?: ?([a-z+\-\[]\S*))?)?"


def _all(y: str, m: str, d: str, first: int) -> str:
    return "#" + "|".join([y, m, d, *(f"${first + i}" for i in range(6))])


#: (name, pattern, canonical form); canonical is #year|month|day|hour|minute|second|fraction|a or p|zone.
CASCADE: tuple[tuple[str, str, str], ...] = (
    ("year first", r"([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})" + _CLOCK, _all("$1", "$3", "$4", 5)),
    ("packed", r"([0-9]{4})([0-9]{2})([0-9]{2})" + _PACKED, _all("$1", "$2", "$3", 4)),
    ("day first", r"dmy:([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-9]{4}|[0-9]{2})" + _CLOCK, _all("$4", "$3", "$1", 5)),
    ("month first", r"mdy:([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-9]{4}|[0-9]{2})" + _CLOCK, _all("$4", "$1", "$3", 5)),
    ("day of month", _WEEKDAY + r"([0-9]{1,2}) de " + _MONTH + r"\.?(?: del?|,)? ([0-9]{4})" + _CLOCK, _all("$3", "$2", "$1", 4)),
    ("day month year", _WEEKDAY + r"([0-9]{1,2})[- /.]" + _MONTH + r"\.?[- /.]([0-9]{4}|[0-9]{2})" + _CLOCK, _all("$3", "$2", "$1", 4)),
    ("month day year", _WEEKDAY + _MONTH + r"\.? ([0-9]{1,2}),? ([0-9]{4})" + _CLOCK, _all("$3", "$1", "$2", 4)),
)
_EPOCH = r"\A[0-9]{10}(?:[0-9]{3}|[0-9]{6}|[0-9]{9})?\z"
_SERIAL = r"\A([0-9]{5})(\.[0-9]+)?\z"
_DAY = 86_400_000_000


def valid_zone(name: Column) -> Column:
    """The name if it is an IANA zone that this executor's time zone data has, else null; only such names may reach a conversion.

    The engine's own lenient cast decides, so there is no list to ship and none to search for every row.
    """
    real = F.concat(F.lit("2000-01-01 00:00:00 "), name).try_cast("timestamp").isNotNull()
    region = (name.contains("/") & ~name.rlike(r"\A(?:SystemV|Etc)/")) | name.isin("UTC", "GMT")
    return F.when(region & real, name)


def _canonical(s: Column, order: Column) -> Column:
    """One `#y|m|d|h|mi|s|f|ap|zone` string or null; the first pattern of the cascade that fits wins.

    Each rewrite sees the text under its own key; a hit starts with # and passes the rest untouched.
    """
    out = F.concat(order, F.lit(":"), s)
    for _, pattern, form in CASCADE:
        keyed = pattern if pattern.startswith(("dmy:", "mdy:")) else f"...:{pattern}"
        out = F.regexp_replace(out, rf"\A{keyed}\z", form)
    return F.when(out.startswith("#"), out)


def normalise_moments(df: DataFrame, value: str, zone: str, order: str, out: str = "resultado") -> DataFrame:
    """Add `out`: `yyyy-MM-dd` when the value has no time, else the UTC moment
    `yyyy-MM-ddTHH:mm:ss.ffffffZ` (digits after the sixth dropped), or `ilegible`, `inexistente`, `ambigua`.

    Null and blank values give null. `zone` and `order` name the columns with the default
    IANA zone and `dmy`/`mdy` of the row's source; with a null or unknown zone a time without
    its own zone is `ilegible`, a null order counts as `dmy`; a column `out` that is there already is replaced. Column names are kept apart by a
    `__ts_` prefix; all other columns pass through. One narrow projection, no shuffle.
    """
    p = "__ts_"
    df = df.drop(out)
    passed = df.columns
    c = lambda n: F.col(p + n)
    add = lambda __df, **cols: once(__df, **{p + k: v for k, v in cols.items()})
    table = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])

    df = add(df, raw=F.regexp_replace(trim_ws(F.col(value).cast("string")), f"{WS}+", " "), order=F.when(F.col(order) == "mdy", "mdy").otherwise("dmy"))
    df = add(df, s=F.lower(strip_marks(c("raw"))))
    df = add(df, parts=F.split(F.substr(_canonical(c("s"), c("order")), F.lit(2)), r"\|", 9), number=F.translate(c("s"), ",", "."))
    part = lambda i: F.get(c("parts"), F.lit(i))
    num = lambda x: x.try_cast("int")

    month = F.coalesce(num(part(1)), F.try_element_at(table(MONTHS), F.substring(part(1), 1, 3)))
    year = num(part(0)) + F.when(F.length(part(0)) == 2, 2000).otherwise(0)
    # A bracketed or spaced zone: offset, abbreviation or zone name.
    zone_text = F.regexp_replace(F.regexp_replace(part(8), r"\A\[(.*)\]\z", "$1"), r"\A(?:utc|gmt)(?=[+-])", "")
    df = add(
        df, y=year, m=month, d=num(part(2)), h=num(part(3)), mi=num(part(4)), sec=F.when(part(5) == "", F.lit(0)).otherwise(num(part(5))),
        frac=F.rpad(F.substring(part(6), 1, 6), 6, "0").cast("int"), ap=part(7), z=zone_text, timed=F.coalesce(part(3) != "", F.lit(False)),
        serial=F.regexp_extract(c("number"), _SERIAL, 1), tail=F.regexp_extract(c("number"), _SERIAL, 2),
        epoch=F.regexp_extract(c("s"), _EPOCH, 0),
        own=F.regexp_extract(c("raw"), r"([A-Za-z_]+(?:/[A-Za-z_+\-0-9]+)+)\]?\z", 1),
    )

    # Strict ranges: a real day from year 100 on, hours to 23, or 1 to 12 beside a.m./p.m.
    day = F.when(c("y") >= 100, F.format_string("%04d-%02d-%02d", c("y"), c("m"), c("d")).try_cast("date"))
    hour = F.when(c("ap") == "", F.when(c("h") <= 23, c("h"))).otherwise(F.when(c("h").between(1, 12), c("h") % 12 + F.when(c("ap") == "p", 12).otherwise(0)))
    off = r"\A([+-])([0-9]{1,2}):?([0-9]{2})?\z"
    oh, om = num(F.regexp_extract(c("z"), off, 2)), F.coalesce(num(F.regexp_extract(c("z"), off, 3)), F.lit(0))
    minutes = F.when((oh <= 18) & (om <= 59), (oh * 60 + om) * F.when(c("z").startswith("-"), -1).otherwise(1))
    n = F.length(c("epoch"))
    # A number as long as an epoch count: seconds, or the first 16 digits scaled to microseconds.
    epoch_us = F.substring(c("epoch"), 1, 16).try_cast("bigint") * F.when(n == 10, 1_000_000).when(n == 13, 1000).otherwise(1)
    # A serial number counts days on the source's clocks; its fraction is taken exactly.
    fraction = F.concat(F.lit("0"), F.substring(c("tail"), 1, 19)).try_cast("decimal(19,18)")
    within = F.floor(fraction * F.lit(_DAY).cast("decimal(12,0)")).cast("bigint")
    is_serial = c("serial") != ""
    df = add(
        df, day=F.when(is_serial, F.date_from_unix_date(num(c("serial")) - 25569)).otherwise(day), hour=hour,
        fixed=F.coalesce(minutes, F.try_element_at(table(ABBREVIATIONS), c("z"))), us0=epoch_us, within=F.when(is_serial & (c("tail") != ""), within),
    )
    clock = F.when((c("mi") <= 59) & (c("sec") <= 59), ((c("hour") * 60 + c("mi")) * 60 + c("sec")).cast("bigint") * 1_000_000 + c("frac"))
    name = F.when(is_serial | (c("z") == ""), F.col(zone)).when(c("z").contains("/"), c("own"))
    df = add(
        df, wall=F.unix_date(c("day")).cast("bigint") * _DAY + F.coalesce(c("within"), clock), has_clock=c("timed") | c("within").isNotNull(),
        fix=F.when(~is_serial, c("fixed")), zone=valid_zone(name),
    )

    # Wall clock to UTC. Spark takes the earlier offset where clocks are set back and moves on where
    # they skip; turning back shows a gap, and the offsets of the days around show an overlap of any length.
    shown = lambda us: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), c("zone")))
    df = add(df, u=F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(c("wall")), c("zone"))))
    df = add(df, back=shown(c("u")), v=c("wall") - (shown(c("u") + _DAY) - (c("u") + _DAY)), w=c("wall") - (shown(c("u") - _DAY) - (c("u") - _DAY)))
    twice = ((c("v") != c("u")) & (shown(c("v")) == c("wall"))) | ((c("w") != c("u")) & (shown(c("w")) == c("wall")))
    df = add(
        df, verdict=F.when(c("back") != c("wall"), SKIPPED).when(twice, TWICE),
        us=F.coalesce(c("us0"), F.when(c("fix").isNotNull(), c("wall") - c("fix").cast("bigint") * 60_000_000).otherwise(c("u"))),
    )
    df = add(df, rest=F.pmod(c("us"), F.lit(_DAY)))
    at = lambda per, mod: F.expr(f"cast(({p}rest div {per}L) % {mod} as int)")
    stamp = F.concat(
        F.date_from_unix_date(F.expr(f"cast(({p}us - {p}rest) div {_DAY}L as int)")).cast("string"),
        F.format_string("T%02d:%02d:%02d.%06dZ", at(3_600_000_000, 24), at(60_000_000, 60), at(1_000_000, 60), at(1, 1_000_000)),
    )
    result = (
        F.when(c("us0").isNotNull(), stamp)
        .when(c("day").isNull(), UNREADABLE)
        .when(~c("has_clock"), c("day").cast("string"))
        .when(c("wall").isNull() | (c("fix").isNull() & c("zone").isNull()), UNREADABLE)
        .when(c("fix").isNotNull(), stamp)
        .when(c("verdict").isNotNull(), c("verdict"))
        .otherwise(stamp)
    )
    return once(df, **{out: F.when(~is_blank(F.col(value)), result)}).select(*passed, out)


def is_final(value: Column) -> Column:
    """The value already is its own final form: a real day or moment from year 100 on, spelled exactly so."""
    real = F.when(value.rlike(FINAL_DAY), value.try_cast("date").isNotNull()).when(value.rlike(FINAL_MOMENT), value.try_cast("timestamp").isNotNull())
    return F.coalesce(real & (value >= "0100"), F.lit(False))


def lead_moments(leads: DataFrame, lots: DataFrame, max_lots: int = 100_000) -> DataFrame:
    """`lead_id, fecha_carga, resultado` of every lead. Lots are broadcast only if counted at most
    `max_lots`; a lead without its lot has no zone. Repeated leads stay repeated, empty tables give no rows."""
    zones = lots.select("archivo_id", F.col("zona_horaria").alias("__zone"), F.col("orden_fecha").alias("__order")).dropDuplicates(["archivo_id"])
    joined = leads.select("lead_id", "archivo_id", "fecha_carga").join(small_side(zones, max_lots), "archivo_id", "left")
    return normalise_moments(joined, "fecha_carga", "__zone", "__order").select("lead_id", "fecha_carga", "resultado")


def found(spark, sf_dir: str) -> DataFrame:
    """Problem 2: every `fecha_carga` that is neither blank nor final, with its final form."""
    leads = spark.read.parquet(f"{sf_dir}/leads_prueba_sintetico_1.parquet")
    lots = spark.read.parquet(f"{sf_dir}/archivos.parquet")
    # Final forms give themselves; leaving them out before the cascade spares it half the rows.
    out = lead_moments(leads.where(~is_final(F.col("fecha_carga"))), lots)
    return out.where("resultado is not null").select("lead_id", "resultado")


assert all(re.compile(p.replace("dmy:", "").replace("mdy:", "")) for _, p, _ in CASCADE)
