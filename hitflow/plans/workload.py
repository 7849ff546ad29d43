"""Edge log lines derived from the ``events`` table.

Every event becomes one line: views turn into impressions, clicks and purchases into site visits, sign-ups
into health checks, errors into damaged lines. Parameter spelling, escapes, addresses and stamps vary from
row to row so that every branch of parsing is met. The same SELECT runs in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitflow.sources.tables import widen

LINES_SELECT = """
SELECT id, host, file, line_num, ingest_time,
       concat(stamp, chr(9), '192.0.2.1', chr(9), 'GET', chr(9), path, '?', query, chr(9), query, chr(9),
              '200', chr(9), 'ua ', user_id, chr(9), '-',
              CASE WHEN event_type = 'error' AND id % 3 = 0 THEN '' ELSE concat(chr(9), address) END) AS raw
FROM (
  SELECT event_id AS id, event_type, user_id,
         concat('edge', event_id % 9) AS host,
         concat('access.log-', {day}) AS file,
         event_id + 1 AS line_num,
         ts AS ingest_time,
         CASE WHEN event_type = 'error' AND event_id % 3 = 2 THEN 'now'
              WHEN event_type = 'purchase' AND event_id % 23 = 2 THEN '20240101'
              ELSE concat({stamp}, '+12:00') END AS stamp,
         CASE WHEN event_type = 'error' AND event_id % 3 = 1 THEN '-'
              WHEN user_id % 5 = 3 THEN concat('2001:DB8:0:0:0:0:', hex(1 + user_id % 65535), ':1, 203.0.113.9')
              ELSE concat('10.', (user_id >> 16) & 255, '.', (user_id >> 8) & 255, '.', user_id & 255,
                          ', 203.0.113.9') END AS address,
         CASE WHEN event_type = 'view' OR (event_type = 'error' AND event_id % 3 = 2)
                THEN CASE WHEN event_id % 2 = 0 THEN '/impression' ELSE '/viewer' END
              WHEN event_type IN ('click', 'error') THEN '/client'
              WHEN event_type = 'purchase' THEN CASE event_id % 4
                WHEN 0 THEN '/response' WHEN 1 THEN 'http://tags.example/response'
                WHEN 2 THEN '/response;v=2' ELSE '//tags.example/response' END
              ELSE '/health_check' END AS path,
         CASE WHEN event_type = 'view' THEN CASE event_id % 23
                WHEN 1 THEN concat('client=', user_id % 7, '&campaign=', event_id % 11, '&creative=', event_id % 13, '&cb=')
                WHEN 2 THEN concat('client=&client=', user_id % 7, '&booking=', event_id % 11, '&creative=', event_id % 13, '%27%20style')
                WHEN 3 THEN concat('client=x&c=', user_id % 7, '&b=', event_id % 11, '&r=', event_id % 13)
                WHEN 4 THEN concat('c=', user_id % 7, '&b=', event_id % 11)
                WHEN 5 THEN concat('c=%3', user_id % 7, '&b=', event_id % 11, '&r=', event_id % 13)
                WHEN 6 THEN concat('c=99999999999&b=', event_id % 11, '&r=', event_id % 13)
                WHEN 7 THEN concat('%63=', user_id % 7, '&%62=', event_id % 11, '&r=', event_id % 13, '&r=9')
                ELSE concat('c=', user_id % 7, '&b=', event_id % 11, '&r=', event_id % 13, '&v=', event_id) END
              WHEN event_type = 'click' THEN CASE event_id % 23
                WHEN 1 THEN concat('c=', user_id % 7, '&s=', event_id % 5)
                WHEN 2 THEN concat('client=', user_id % 7, '&site=%zz', event_id % 5)
                WHEN 3 THEN concat('client=', user_id % 7, ';site=', event_id % 5)
                WHEN 4 THEN concat('client=', user_id % 7, '&site=', event_id % 5, '&site=9')
                WHEN 5 THEN concat('site=', event_id % 5, '&cb=1&client=', user_id % 7)
                ELSE concat('client=', user_id % 7, '&site=', event_id % 5, '%27%20style=%27x') END
              WHEN event_type = 'purchase' THEN CASE event_id % 23
                WHEN 1 THEN concat('c=x&s=', event_id % 5)
                ELSE concat('c=', user_id % 7, '&s=', event_id % 5) END
              WHEN event_type = 'error' THEN CASE event_id % 3
                WHEN 2 THEN concat('c=', user_id % 7, '&b=', event_id % 11, '&r=', event_id % 13)
                ELSE concat('client=', user_id % 7, '&site=', event_id % 5) END
              ELSE '-' END AS query
  FROM {events}
) AS e
"""

SPARK_STAMP = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
SPARK_DAY = "date_format(ts, 'yyyyMMdd')"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_from_events(events: DataFrame) -> DataFrame:
    """Log lines: id, host, file, line_num, ingest_time, raw."""
    text = LINES_SELECT.replace("{stamp}", SPARK_STAMP).replace("{day}", SPARK_DAY)
    return events.sparkSession.sql(text, events=events)


def load_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return lines_from_events(widen(events))
