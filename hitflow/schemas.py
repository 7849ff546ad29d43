"""Table and message layouts."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BIGINT, DATE, TIME = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.TimestampNTZType(),
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# One raw log line with its place of origin. Line numbers are BIGINT: a busy edge outgrows INT.
RAW_LINES = _schema(host=STRING, file=STRING, line_num=BIGINT, raw=STRING)
ENVELOPE = _schema(host=STRING, line_num=BIGINT, raw=STRING)

# The nine tab-separated fields of a log line, in order.
LOG_FIELDS = (
    "timestamp", "edge_ip", "method", "url", "query_string",
    "status", "user_agent", "referer", "client_ip",
)

# A classified entry as it travels between stages.
ENTRY = _schema(
    timestamp=STRING, edge_ip=STRING, method=STRING, path=STRING, query_string=STRING, status=STRING,
    user_agent=STRING, referer=STRING, client_ip=STRING, host=STRING, line_num=BIGINT,
    query=T.MapType(STRING, STRING),
)

IMPRESSIONS = _schema(
    id=BIGINT, timestmp=TIME, client_id=INT, booking_id=INT, creative_id=INT, ipaddress=STRING,
    useragent=STRING,
)
WEBHITS = _schema(
    id=BIGINT, timestmp=TIME, client_id=INT, site_id=INT, ipaddress=STRING, impression_id=BIGINT
)
LAST_SITE_RESPONSE = _schema(date=DATE, client_id=INT, sitetag_id=INT, hits=BIGINT)
LAST_IMPRESSION_RESPONSE = _schema(date=DATE, client_id=INT, booking_id=INT, creative_id=INT, hits=BIGINT)
PROCESSING_STATE = _schema(entity_type=STRING, last_id=BIGINT, updated_at=TIME)
TAIL_STATE = _schema(host=STRING, file=STRING, last_line_num=BIGINT, first_line_hash=STRING)
