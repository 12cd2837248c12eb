"""Queries of the general data-processing problems, with their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.operators import dedupe, history, late, schema_drift, timestamps, trips
from harborline.session import comparable, scratch_path, table


def p1_found(spark, sf):
    """Each timestamp that states an instant, and that instant."""
    found = timestamps.normalise(table(spark, sf, "raw_messages"), table(spark, sf, "facilities"))
    return found.where("utc_us IS NOT NULL").select("message_id", "field_name", "utc_us")


def _facilities(spark, sf):
    return history.facility_history(table(spark, sf, "facilities"), table(spark, sf, "facility_updates"))


def _drivers(spark, sf):
    return history.driver_history(table(spark, sf, "driver_updates"))


def p4_facilities(spark, sf):
    """History of facilities."""
    return comparable(_facilities(spark, sf))


def p4_drivers(spark, sf):
    """History of drivers."""
    return comparable(_drivers(spark, sf))


def p4_found(spark, sf):
    """Each start of a version."""
    starts = lambda df, kind: df.select(F.lit(kind).alias("entity_kind"), F.col("entity").alias("entity_id"), F.unix_micros("valid_from").alias("valid_from_us"))
    return starts(_facilities(spark, sf), "facility").unionByName(starts(_drivers(spark, sf), "driver"))


def p5_segments(spark, sf):
    """Stops and trips with start, end, duration and distance."""
    return trips.segments(table(spark, sf, "driver_locations"))


def p5_found(spark, sf):
    """Stops and trips by their first and last pings."""
    return p5_segments(spark, sf).select("driver_id", "segment_kind", "first_ping_id", "last_ping_id")


def p6_found(spark, sf):
    """Each change of the payload's fields between consecutive files of a feed."""
    return schema_drift.changes(schema_drift.profiles(table(spark, sf, "landed_records")))


def p6_table(event_type: str):
    """One consistent table of an event type."""
    return lambda spark, sf: schema_drift.unified(table(spark, sf, "landed_records"), event_type)


_LANDED = ["delivery.completed", "shipment.created", "driver.location_updated", "facility.capacity_changed"]


def p7_found(spark, sf):
    """Every row that isn't the kept copy of its event."""
    rows = dedupe.keyed(table(spark, sf, "shipment_events").select("message_id", "event_type", "event_id", "ingest_time"))
    rows = rows.select("message_id", "_key", "_ord", "ingest_time")
    return dedupe.copies(rows, dedupe.SeenStore(spark, scratch_path(spark, "seen")).deliver_in_order(rows, "ingest_time"))


def _kept(spark, sf):
    return late.kept_events(table(spark, sf, "shipment_events"))


def p3_found(spark, sf):
    """Kept copies that came after the end of their period."""
    return late.late_rows(_kept(spark, sf))


def p3_revisions(spark, sf):
    """Every corrected count per facility and period."""
    return comparable(late.revisions(_kept(spark, sf)))


def p3_too_late(spark, sf):
    """Counts of what came beyond the cut-off."""
    return comparable(late.beyond_cutoff(_kept(spark, sf)))


_RANKED = r"""
    SELECT *, row_number() OVER (PARTITION BY lower(trim(event_type)),
        CASE WHEN regexp_matches(regexp_replace(lower(trim(event_id, e' \t\n\r')), '^urn:uuid:|[{}()\-\s]', '', 'g'), '^[0-9a-f]{32}$')
             THEN regexp_replace(lower(trim(event_id, e' \t\n\r')), '^urn:uuid:|[{}()\-\s]', '', 'g') ELSE lower(trim(event_id, e' \t\n\r')) END
        ORDER BY ingest_time NULLS LAST, message_id) AS rn
    FROM shipment_events"""
_CLASSIFIED = f"""
    SELECT message_id, facility_id, p, a, CASE WHEN a < p + 300000000 THEN 'on_time' WHEN a < p + 86700000000 THEN 'late' ELSE 'too_late' END AS arrival
    FROM (SELECT *, epoch_us(event_time) - epoch_us(event_time) % 300000000 AS p, epoch_us(ingest_time) AS a FROM ({_RANKED}) WHERE rn = 1)"""



def _history(entity: str, attributes: list[str], source: str, created: str) -> str:
    """SQL of versions(): created is a query of creation rows, or empty if the first row creates."""
    named = lambda a: f"CASE WHEN updated_fields IS NULL THEN {a} IS NOT NULL ELSE list_contains(list_transform(updated_fields, lambda x: lower(regexp_replace(x, '([a-z])([A-Z])', '\\1_\\2', 'g'))), '{a}') END"
    sets = ", ".join(f"CASE WHEN {named(a)} THEN {{'v': {a}}} END AS s_{a}" for a in attributes)
    full = ", ".join(f"last_value(s_{a} IGNORE NULLS) OVER w AS s_{a}" for a in attributes)
    values = ", ".join(f"s_{a}.v AS {a}" for a in attributes)
    same = " AND ".join(f"{a} IS NOT DISTINCT FROM lag({a}) OVER v" for a in attributes)
    return f"""
    WITH u AS (SELECT {entity} AS entity, event_time AS t, 1 AS k, ingest_time AS i, update_id AS n, {'NULL' if created else 'true'} AS c, {sets}
               FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_time, update_id) AS rn FROM {source}) WHERE rn = 1 {created}),
         f AS (SELECT entity, t, k, i, n, last_value(c IGNORE NULLS) OVER w AS c, {full} FROM u
               WINDOW w AS (PARTITION BY entity ORDER BY t, k, i, n ROWS UNBOUNDED PRECEDING)),
         l AS (SELECT entity, t, {values} FROM f WHERE c QUALIFY row_number() OVER (PARTITION BY entity, t ORDER BY k DESC, i DESC, n DESC) = 1),
         s AS (SELECT *, lag(t) OVER v IS NULL OR NOT ({same}) AS starts FROM l WINDOW v AS (PARTITION BY entity ORDER BY t)),
         h AS (SELECT entity, {', '.join(attributes)}, t AS valid_from, lead(t) OVER (PARTITION BY entity ORDER BY t) AS valid_to FROM s WHERE starts)
    SELECT *, valid_to IS NULL AS is_current FROM h"""


_FACILITIES = _history("facility_id", ["facility_name", "status", "capacity_units"], "facility_updates", """
    UNION ALL SELECT DISTINCT facility_id, event_time, 0, NULL, NULL, true, {'v': facility_name}, {'v': status}, {'v': capacity_units} FROM facilities""")
_DRIVERS = _history("driver_id", ["home_facility_id"], "driver_updates", "")

def _instants_sql() -> str:
    """SQL of p1_found: a text is parted into its head, read by strptime's formats, and its tail, the zone."""
    offsets = ", ".join(f"('{k}', {v})" for k, v in timestamps.ABBREVIATIONS.items())
    clock = ("%H:%M:%S", "%H:%M", "%I:%M:%S %p", "%I:%M %p")
    formats = lambda *dates: "[" + ", ".join(f"'{d} {c}'" for d in dates for c in clock) + "]"
    plain = formats("%Y-%m-%d", "%d %B %Y", "%d %b %Y", "%b %d, %Y", "%B %d, %Y", "%Y-%j")[:-1] + ", '%Y%m%d %H%M%S', '%H:%M:%S %Y-%m-%d', '%H:%M %Y-%m-%d']"
    return f"""
    WITH abbreviation(name, minutes) AS (VALUES {offsets}), zone AS (SELECT DISTINCT lower(name) AS k, first(name) AS name FROM pg_timezone_names() GROUP BY 1),
    w AS (SELECT message_id, source_system, facility_id, unnest(['event_time', 'timestamp']) AS field_name, unnest([event_time, CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.timestamp') END]) AS written FROM raw_messages),
    t AS (SELECT *, upper(regexp_replace(regexp_replace(written, '^[\\s"''\\x{{a0}}]+|[\\s"''\\x{{a0}}]+$', '', 'g'), '\\s+', ' ', 'g')) AS t FROM w WHERE written IS NOT NULL),
    o AS (SELECT source_system, count(*) FILTER (a > 12) > count(*) FILTER (b > 12) AS day_first
          FROM (SELECT source_system, TRY_CAST(regexp_extract(t, '^(\\d+)[/.]\\d+[/.]\\d{{4}} ', 1) AS INT) AS a, TRY_CAST(regexp_extract(t, '^\\d+[/.](\\d+)[/.]\\d{{4}} ', 1) AS INT) AS b FROM t) GROUP BY 1),
    f AS (SELECT facility_id, zone.name AS default_zone FROM (SELECT facility_id, min(timezone) AS z FROM facilities GROUP BY 1) LEFT JOIN zone ON k = regexp_replace(lower(regexp_replace(z, '^\\s+|\\s+$', '', 'g')), '\\s+', '_', 'g')),
    parts AS (SELECT t.*, day_first, default_zone, regexp_extract(t, '\\[([A-Z0-9_/+-]+)\\]$', 1) AS named, regexp_replace(t, '\\[[A-Z0-9_/+-]+\\]$', '') AS u
              FROM t LEFT JOIN o USING (source_system) LEFT JOIN f USING (facility_id)),
    tails AS (SELECT *, trim(regexp_extract(u, '(?:[:\\dM][\\d.,]*|\\dT\\d+)( ?(?:Z|UTC?|[A-Z]{{3,4}}|[+-]\\d\\d(?::?\\d\\d)?))$', 1)) AS tail FROM parts),
    timed AS (SELECT *, CASE WHEN regexp_matches(u, '^\\d{{4}}-\\d\\d-\\d\\d$') THEN '' ELSE tail END AS z FROM tails),
    heads AS (SELECT *, trim(left(u, length(u) - length(z))) AS h FROM timed),
    cut AS (SELECT *, regexp_extract(h, ':\\d\\d[.,](\\d+)', 1) AS frac, regexp_replace(regexp_replace(regexp_replace(h, '(:\\d\\d)[.,]\\d+', '\\1'), '^[A-Z]+,? (\\d+ [A-Z])', '\\1'), '(\\d)T(\\d)|^(\\d{{8}})(\\d{{6}})$', '\\1\\3 \\2\\4') AS h1 FROM heads),
    whole AS (SELECT *, regexp_matches(h1, ' 24:00(:00)?$') AS midnight, regexp_replace(regexp_replace(h1, ' 24:00', ' 00:00'), '([AP]M)$', ' \\1') AS h2 FROM cut),
    dated AS (SELECT *, regexp_replace(h2, '  +', ' ') AS h3 FROM whole),
    wall AS (SELECT *, coalesce(CASE WHEN regexp_matches(h3, '^\\d\\d?[/.]\\d\\d?[/.]\\d{{4}} ') THEN CASE WHEN day_first THEN try_strptime(replace(h3, '.', '/'), {formats("%d/%m/%Y")}) ELSE try_strptime(replace(h3, '.', '/'), {formats("%m/%d/%Y")}) END
                                 ELSE try_strptime(regexp_replace(h3, '^([A-Z]{{3}})[A-Z]* (\\d)', '\\1 \\2'), {plain}) END) + CASE WHEN midnight THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
                                 + to_microseconds(CAST(rpad(left(frac, 6), 6, '0') AS BIGINT)) AS wt FROM dated WHERE regexp_matches(u, '[-/.: T]|^\\d{{14}}')),
    placed AS (SELECT wall.*, minutes, CASE WHEN regexp_matches(z, '^[+-]') THEN (CASE WHEN z LIKE '-%' THEN -1 ELSE 1 END) * (CAST(z[2:3] AS INT) * 60 + coalesce(TRY_CAST(right(replace(z, ':', '')[4:], 2) AS INT), 0)) ELSE minutes END AS off,
                      CASE WHEN named <> '' THEN zone.name ELSE coalesce(default_zone, 'UTC') END AS zn
               FROM wall LEFT JOIN abbreviation ON abbreviation.name = z LEFT JOIN zone ON k = lower(named)),
    local AS (SELECT *, timezone(zn, wt) AS x FROM placed WHERE wt IS NOT NULL AND z = ''),
    numbers AS (SELECT message_id, field_name, TRY_CAST(t AS DECIMAL(38,12)) AS n FROM t WHERE regexp_matches(t, '^-?\\d+(\\.\\d*)?$') AND NOT regexp_matches(t, '^\\d{{14}}$'))
    SELECT message_id, field_name, epoch_us(wt) - CAST(off AS BIGINT) * 60000000 AS utc_us FROM placed WHERE wt IS NOT NULL AND z <> '' AND off IS NOT NULL
    UNION ALL SELECT message_id, field_name, epoch_us(CASE WHEN timezone(zn, x - INTERVAL 1 HOUR) = wt THEN x - INTERVAL 1 HOUR WHEN timezone(zn, x - INTERVAL 30 MINUTE) = wt THEN x - INTERVAL 30 MINUTE ELSE x END) FROM local WHERE zn IS NOT NULL
    UNION ALL SELECT message_id, field_name, CAST(CASE WHEN abs(n) >= 1e8 AND abs(n) < 1e11 THEN floor(n * 1000000) WHEN abs(n) >= 1e11 AND abs(n) < 1e14 THEN floor(n * 1000) ELSE floor(n) END AS BIGINT) FROM numbers WHERE abs(n) >= 1e8 AND abs(n) < 1e17"""


QUERIES = {"p1_found": p1_found, "p5_found": p5_found, "p5_segments": p5_segments, "p6_found": p6_found, "p4_found": p4_found, "p4_facilities": p4_facilities, "p4_drivers": p4_drivers, "p7_found": p7_found, "p3_found": p3_found, "p3_revisions": p3_revisions, "p3_too_late": p3_too_late}
QUERIES |= {f"p6_table_{t.replace('.', '_')}": p6_table(t) for t in _LANDED}
ORACLE = {
    "p4_facilities": f"SELECT * REPLACE (epoch_us(valid_from) AS valid_from, epoch_us(valid_to) AS valid_to) FROM ({_FACILITIES})",
    "p4_drivers": f"SELECT * REPLACE (epoch_us(valid_from) AS valid_from, epoch_us(valid_to) AS valid_to) FROM ({_DRIVERS})",
    "p4_found": f"""SELECT 'facility' AS entity_kind, entity AS entity_id, epoch_us(valid_from) AS valid_from_us FROM ({_FACILITIES})
        UNION ALL SELECT 'driver', entity, epoch_us(valid_from) FROM ({_DRIVERS})""",
    "p7_found": f"SELECT message_id FROM ({_RANKED}) WHERE rn > 1",
    "p3_found": f"SELECT message_id, arrival FROM ({_CLASSIFIED}) WHERE arrival <> 'on_time'",
    "p3_revisions": f"""
        WITH cells AS (SELECT facility_id, p, greatest(p, a - a % 300000000) AS q, count(*) AS added FROM ({_CLASSIFIED}) WHERE arrival <> 'too_late' GROUP BY ALL)
        SELECT facility_id, p AS period_start, q AS arrival_start, added,
               row_number() OVER w AS revision, CAST(sum(added) OVER w AS BIGINT) AS total
        FROM cells WINDOW w AS (PARTITION BY facility_id, p ORDER BY q ROWS UNBOUNDED PRECEDING)""",
    "p3_too_late": f"SELECT facility_id, p AS period_start, count(*) AS too_late FROM ({_CLASSIFIED}) WHERE arrival = 'too_late' GROUP BY ALL",
    "p1_found": _instants_sql(),
}
