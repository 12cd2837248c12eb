"""Aggregates by event time that are corrected as late records arrive; SQL only.

The triangle has a cell for each (key, event period, arrival period). Summed cumulatively across arrivals it gives every
revision a consumer has seen; arrivals beyond the cut-off are no part of it and come out apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from harborline.session import materialize

PERIOD_S, CUTOFF_S = 300, 86_400


#: Problem 7's key and order of arrival, as SQL (see dedupe).
_BLANKS = " \\t\\r\\n\\u000c\\u000b\\u00a0"
_PLAIN = f"lower(btrim(event_id, '{_BLANKS}'))"
_BARE = f"translate(replace({_PLAIN}, 'urn:uuid:', ''), '{{}}()-{_BLANKS}', '')"
_KEY = rf"concat(coalesce(lower(trim(event_type)), ''), ':', CASE WHEN {_BARE} RLIKE r'^[0-9a-f]{{32}}$' THEN {_BARE} ELSE {_PLAIN} END)"
_FAR = 9_000_000_000_000_000_000


def kept_events(df: DataFrame, row_id: str = "message_id") -> DataFrame:
    """The kept copy of each event, with only what the triangle needs, in one pass; rows without an identifier stay."""
    spark = df.sparkSession
    order = f"CAST(coalesce(unix_micros(ingest_time), {_FAR}) AS DECIMAL(19,0)) * CAST('1{'0' * 19}' AS DECIMAL(20,0)) + CAST(coalesce({row_id}, {_FAR}) AS DECIMAL(19,0))"
    key = _KEY.replace("{", "{{").replace("}", "}}")  # braces are fields of a formatted statement
    return spark.sql(
        f"""
        SELECT x.* FROM (
            SELECT min_by(struct({row_id}, facility_id, event_time, ingest_time), {order}) AS x
            FROM (SELECT {row_id}, facility_id, event_time, ingest_time, {key} AS _key FROM {{df}})
            GROUP BY _key, CASE WHEN _key IS NULL THEN monotonically_increasing_id() END)
        """,
        df=df,
    )


def classified(kept: DataFrame, period_s: int = PERIOD_S, cutoff_s: int = CUTOFF_S) -> DataFrame:
    """kept with period_start, arrival_start and arrival: on_time, late, too_late, or null where a time is missing.

    Periods are half-open and aligned to 1970 UTC. Everything before the end of its period shares one arrival period.
    """
    return kept.sparkSession.sql(
        f"""
        SELECT *, CASE WHEN at < p + {period_s * 1_000_000} THEN 'on_time'
                       WHEN at < p + {(period_s + cutoff_s) * 1_000_000} THEN 'late' ELSE 'too_late' END AS arrival,
               timestamp_micros(p) AS period_start,
               timestamp_micros(greatest(p, at - pmod(at, {period_s * 1_000_000}))) AS arrival_start
        FROM (SELECT *, unix_micros(event_time) - pmod(unix_micros(event_time), {period_s * 1_000_000}) AS p,
                     unix_micros(ingest_time) AS at
              FROM {{kept}} WHERE event_time IS NOT NULL AND ingest_time IS NOT NULL)
        """,
        kept=kept,
    )


def revisions(kept: DataFrame, period_s: int = PERIOD_S, cutoff_s: int = CUTOFF_S) -> DataFrame:
    """Every corrected revision (facility_id, period_start, revision, arrival_start, added, total).

    Cells are summed before the window, so that the window over one (facility, period) holds at most
    cut-off / period + 1 rows however hot the facility is.
    """
    return kept.sparkSession.sql(
        """
        WITH cells AS (SELECT facility_id, period_start, arrival_start, count(*) AS added FROM {c}
                       WHERE arrival <> 'too_late' GROUP BY facility_id, period_start, arrival_start)
        SELECT facility_id, period_start, arrival_start, added,
               CAST(row_number() OVER w AS BIGINT) AS revision, sum(added) OVER w AS total
        FROM cells
        WINDOW w AS (PARTITION BY facility_id, period_start ORDER BY arrival_start ROWS UNBOUNDED PRECEDING)
        """,
        c=classified(kept, period_s, cutoff_s),
    )


def beyond_cutoff(kept: DataFrame, period_s: int = PERIOD_S, cutoff_s: int = CUTOFF_S) -> DataFrame:
    """Counts of arrivals beyond the cut-off, per facility and period."""
    return kept.sparkSession.sql(
        "SELECT facility_id, period_start, count(*) AS too_late FROM {c} WHERE arrival = 'too_late' GROUP BY facility_id, period_start",
        c=classified(kept, period_s, cutoff_s),
    )


def late_rows(kept: DataFrame, period_s: int = PERIOD_S, cutoff_s: int = CUTOFF_S, row_id: str = "message_id") -> DataFrame:
    """(row_id, arrival) of each record that came after its period: late if a revision of the triangle counts it, too_late if none does.

    Of the records only those that arrived after their period are joined with the revisions; a record has one at most.
    """
    c = materialize(kept, "kept")
    return kept.sparkSession.sql(
        f"""
        SELECT {row_id}, CASE WHEN r.total IS NOT NULL THEN 'late' ELSE 'too_late' END AS arrival
        FROM (SELECT * FROM {{c}} WHERE arrival_start > period_start) c LEFT JOIN {{r}} r
        ON c.facility_id <=> r.facility_id AND c.period_start = r.period_start AND c.arrival_start = r.arrival_start
        """,
        c=classified(c, period_s, cutoff_s), r=revisions(c, period_s, cutoff_s),
    )
