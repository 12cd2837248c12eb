"""Timestamps of mixed formats, precisions and zones as one UTC instant.

An ordered cascade of anchored patterns rewrites a text into named fields, which are then put together strictly: a date
that doesn't exist gives null. The zone is the one written, else the source's default zone from a lookup, else UTC.
A repeated local hour means the earlier instant; a skipped one is read with the offset before the change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.lookup import lookup
from harborline.session import materialize, spread

_ZONE = r"(Z|UTC?|[A-Z]{3,4}|[+-]\d{2}(?::?\d{2})?)?"
_CLOCK = r"(\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
#: The cascade: (pattern, fields). Fields: year, month, day (or day of year after "+"), hour, minute, second, fraction, half of day, offset or abbreviation, zone name; the text is upper case by then.
CASCADE: list[tuple[str, str]] = [
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[T ]{_CLOCK} ?{_ZONE}(?:\[([A-Z0-9_/+-]+)\])?$", "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})T?(\d{{2}})(\d{{2}})(\d{{2}}) ?{_ZONE}$", "$1|$2|$3|$4|$5|$6|||$7|"),
    (rf"^(\d{{4}})-(\d{{3}})T{_CLOCK} ?{_ZONE}$", "$1||+$2|$3|$4|$5|$6||$7|"),
    (rf"^{_CLOCK} (\d{{4}})-(\d{{2}})-(\d{{2}}) ?{_ZONE}$", "$5|$6|$7|$1|$2|$3|$4||$8|"),
    (rf"^(?:[A-Z]{{3,9}},? )?(\d{{1,2}}) ([A-Z]{{3}})[A-Z]* (\d{{4}}) {_CLOCK} ?{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7||$8|"),
    (rf"^([A-Z]{{3}})[A-Z]* (\d{{1,2}}), (\d{{4}}) {_CLOCK} ?([AP]M)? ?{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|"),
    # Day and month in the order that the source keeps: "?" before both
    (rf"^(\d{{1,2}})[/.](\d{{1,2}})[/.](\d{{4}}) {_CLOCK} ?([AP]M)? ?{_ZONE}$", "$3|?$1|?$2|$4|$5|$6|$7|$8|$9|"),
]
_NUMERIC_DATE = r"^[\s\"']*(\d{1,2})[/.](\d{1,2})[/.]\d{4}\b"

#: Minutes from UTC of zone abbreviations.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "AKST": -540, "AKDT": -480, "HST": -600, "JST": 540, "AEST": 600, "AEDT": 660, "ACST": 570, "AWST": 480, "IST": 330,
}
_MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC"


def _constant_map(values: dict) -> Column:
    """A map of constants, folded to one literal when the plan is made."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def zone_names(spark: SparkSession) -> Column:
    """Map of lower-case zone name (blanks as underscores) -> name known to the JVM."""
    names = [str(n) for n in spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds().toArray()]
    return _constant_map({n.lower(): n for n in sorted(names)})


def zone_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"\s+", "_"))


def _number(text: str) -> tuple[Column, Column]:
    """The number `_n` in a text, and from `_n` the microseconds since 1970, taken as s, ms or µs by its size."""
    n = f"CASE WHEN {text} RLIKE r'^-?\\d+(\\.\\d*)?(E\\+?\\d+)?$' THEN try_cast({text} AS DECIMAL(38,12)) END"
    size = "abs(_n)"
    return F.expr(n), F.expr(
        f"""CAST(CASE WHEN {size} >= 1e8 AND {size} < 1e11 THEN floor(_n * 1000000) WHEN {size} >= 1e11 AND {size} < 1e14 THEN floor(_n * 1000)
                      WHEN {size} >= 1e14 AND {size} < 1e17 THEN floor(_n) END AS BIGINT)"""
    )


def with_micros(df: DataFrame, text: str, default_zone: str, day_first: str, name: str = "utc_us") -> DataFrame:
    """df with the microseconds since 1970 UTC stated by the column `text`, or null.

    default_zone: column with a zone name known to the JVM, null for UTC. day_first: boolean column for numeric dates.
    Blank texts, placeholders, impossible dates and unknown zones give null. Digits beyond microseconds are cut. The
    steps are separate projections, each used more than once, so that none is copied into the next.
    """
    given, zones = df.columns, zone_names(df.sparkSession)
    whole = lambda c: c.try_cast("int")
    df = df.withColumn("_t", F.upper(F.regexp_replace(F.regexp_replace(text, r"^[\s\"'\u00a0]+|[\s\"'\u00a0]+$", ""), r"\s+", " ")))
    rewritten = F.col("_t")
    for pattern, fields in CASCADE:  # a text that is rewritten fits no later pattern
        rewritten = F.regexp_replace(rewritten, pattern, fields)
    number, micros = _number("_t")
    df = df.withColumns({"_w": rewritten, "_n": number})  # a text that no pattern fits stays as it is
    kinds = "_y INT, _b STRING, _c STRING, _h INT, _m INT, _s INT, _us STRING, _half STRING, _offset STRING, _named STRING"
    fields = F.from_csv("_w", F.lit(kinds), {"sep": "|", "mode": "PERMISSIVE", "quote": ""})
    df = df.select(*given, micros.alias("_number"), F.when(F.col("_w") != F.col("_t"), fields).alias("_f")).select(*given, "_number", "_f.*")
    swap = F.col("_b").startswith("?") & F.coalesce(F.col(day_first), F.lit(False))
    df = df.withColumns({"_b": F.when(swap, F.col("_c")).otherwise(F.col("_b")), "_c": F.when(swap, F.col("_b")).otherwise(F.col("_c"))})
    word = F.floor((F.instr(F.lit(_MONTHS), F.col("_b")) + 3) / 4).cast("int")
    df = df.withColumns({
        "_mo": F.when(F.col("_b").rlike("^[A-Z]{3}$"), F.nullif(word, F.lit(0))).otherwise(whole(F.ltrim(F.col("_b"), F.lit("?")))),
        "_d": whole(F.ltrim(F.col("_c"), F.lit("?+"))), "_doy": F.col("_c").startswith("+"),
        "_h": F.expr("CASE WHEN _half IS NULL THEN _h WHEN _h BETWEEN 1 AND 12 THEN _h % 12 + IF(_half = 'PM', 12, 0) END"),
        "_s": F.coalesce("_s", F.lit(0)), "_us": F.coalesce(F.rpad(F.substring("_us", 1, 6), 6, "0").cast("int"), F.lit(0)),
        "_hh": whole(F.substring("_offset", 2, 2)), "_mm": F.coalesce(whole(F.regexp_extract("_offset", r"^.\d\d:?(\d\d)$", 1)), F.lit(0)),
    })
    df = df.withColumns({
        "_date": F.expr("CASE WHEN _doy THEN date_add(to_date(try_make_timestamp_ntz(_y, 1, 1, 0, 0, 0)), _d - 1) ELSE to_date(try_make_timestamp_ntz(_y, _mo, _d, 0, 0, 0)) END"),
        "_24": F.expr("_h = 24 AND _m = 0 AND _s = 0 AND _us = 0"),
        "_minutes": F.when(F.col("_offset").rlike("^[+-]"), F.expr("CASE WHEN _hh <= 18 AND _mm < 60 THEN IF(_offset LIKE '-%', -1, 1) * (_hh * 60 + _mm) END")).otherwise(_constant_map(ABBREVIATIONS)[F.col("_offset")]),
        "_zone": F.when(F.col("_named").isNotNull(), zones[zone_key(F.col("_named"))]).otherwise(F.coalesce(F.col(default_zone), F.lit("UTC"))),
    })
    df = df.withColumn("_wall", F.expr("""
        (unix_date(CASE WHEN year(_date) = _y THEN _date END) + IF(_24, 1, 0)) * 86400000000L
        + CASE WHEN _24 THEN 0 WHEN _h < 24 AND _m < 60 AND _s < 60 THEN _h * 3600 + _m * 60 + _s END * 1000000L + _us"""))
    local = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("_wall"), F.col("_zone")))
    stated = F.when(F.col("_offset").isNotNull(), F.expr("_wall - _minutes * 60000000L")).otherwise(local)
    return df.select(*given, F.when(F.col("_b").isNull() & F.col("_c").isNull(), F.col("_number")).otherwise(stated).alias(name))


def day_orders(texts: DataFrame, source: str, text: str) -> DataFrame:
    """(source, day_first): the order each source keeps, from every numeric date that can be read in one way only.

    A source without such a date counts as month first. Counted over all rows, combined on the map side.
    """
    a, b = F.regexp_extract(text, _NUMERIC_DATE, 1).try_cast("int"), F.regexp_extract(text, _NUMERIC_DATE, 2).try_cast("int")
    counted = texts.select(source, a.alias("a"), b.alias("b")).where("a IS NOT NULL").groupBy(source)
    counted = counted.agg(F.count_if(F.col("a") > 12).alias("day"), F.count_if(F.col("b") > 12).alias("month"))
    return counted.select(source, (F.col("day") > F.col("month")).alias("day_first"))


def normalise(messages: DataFrame, facilities: DataFrame) -> DataFrame:
    """(message_id, field_name, written, utc_us) for each event_time and payload timestamp that is written at all.

    utc_us is null where no instant is stated. facilities may repeat a facility: its smallest zone spelling counts;
    one that names no zone counts as missing.
    """
    rows = spread(messages.select("message_id", "source_system", "facility_id", "event_time", "payload")).select(
        "message_id", "source_system", "facility_id", F.col("event_time").alias("_e"),
        F.from_json("payload", "timestamp STRING", {"mode": "PERMISSIVE"})["timestamp"].alias("_p"),
    )
    rows = rows.select("message_id", "source_system", "facility_id", F.explode(F.array(F.struct(F.lit("event_time").alias("field_name"), F.col("_e").alias("written")), F.struct(F.lit("timestamp").alias("field_name"), F.col("_p").alias("written")))).alias("x"))
    rows = rows.select("message_id", "source_system", "facility_id", "x.*").where("written IS NOT NULL")
    zones = facilities.groupBy("facility_id").agg(F.min("timezone").alias("timezone"))
    zones = zones.select("facility_id", zone_names(messages.sparkSession)[zone_key(F.col("timezone"))].alias("timezone"))
    orders = day_orders(rows, "source_system", "written")
    rows = lookup(lookup(rows, zones, "facility_id", "message_id"), orders, "source_system", "message_id")
    # written, as a filter on utc_us would else be pushed below the projections, with all their expressions put into it
    return materialize(with_micros(rows, "written", "timezone", "day_first").select("message_id", "field_name", "written", "utc_us"), "instants")
