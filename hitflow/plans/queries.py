"""Every operator as a named query over the given tables.

A query takes a session and a data folder and returns a DataFrame. ``oracles.py`` holds the same
queries as SQL for an independent engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

from hitflow.functions import messages, netaddr, text, times
from hitflow.operators import (
    attribute,
    classify,
    dedupe,
    ids,
    incremental,
    parse,
    rollup,
    tail,
    upsert,
)
from hitflow.plans import pipeline
from hitflow.plans.workload import lines_from_events, load, load_lines
from hitflow.schemas import ENTRY, ENVELOPE, PROCESSING_STATE
from hitflow.session import state_store
from hitflow.sources import logs
from hitflow.sources.staging import new_location, stage
from hitflow.streaming import attribution, consumers, queues, replays, stateful, tailing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Fixed values of the workload: the day on which stored state was saved, and "now" of look-backs.
SAVED_AT = "2024-01-15 00:00:00"
SAVED_DAY_FILE = "access.log-20240115"
AS_OF = "2024-01-31 00:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _saved_at() -> Column:
    return F.lit(SAVED_AT).cast("timestamp_ntz")


def _touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.touches_of(load_lines(spark, sf_dir))


def _routed(spark: SparkSession, sf_dir: str) -> pipeline.Routed:
    return pipeline.route_once(load_lines(spark, sf_dir))


def _tiers(routed: pipeline.Routed) -> tuple[DataFrame, DataFrame]:
    """Running bookings in the first tier, finished ones in the archive."""
    finished = F.col("booking_id") % 3 == 0
    return routed.impressions.where(~finished), routed.impressions.where(finished)


# --- parsing and scalar functions ---------------------------------------------------------------


@query
def parse_lines(spark, sf_dir):
    parsed = parse.parse_lines(load_lines(spark, sf_dir))
    return parsed.select(
        "id", "timestamp", "edge_ip", "method", "path", "query_string", "status", "user_agent",
        "referer", "client_ip",
    )


@query
def url_paths(spark, sf_dir):
    """Paths of the URLs in the log and of all page URLs."""
    logged = load_lines(spark, sf_dir).select(
        F.lit("log").alias("source"), "id", F.get(F.split("raw", "\t"), F.lit(3)).alias("url")
    )
    pages = load(spark, sf_dir, "pages").select(F.lit("page").alias("source"), F.col("page_id").alias("id"), "url")
    both = logged.unionByName(pages)
    return both.select("source", "id", text.url_path(F.col("url")).alias("path"))


@query
def query_params(spark, sf_dir):
    """All parameters of log lines and page URLs, one row each."""
    logged = parse.parse_lines(load_lines(spark, sf_dir)).select(
        F.lit("log").alias("source"), "id", F.col("query_string").alias("q")
    )
    after = F.regexp_extract("url", r"\?([^#]*)", 1)
    pages = load(spark, sf_dir, "pages").select(
        F.lit("page").alias("source"), F.col("page_id").alias("id"), after.alias("q")
    )
    both = logged.unionByName(pages)
    return both.select("source", "id", F.explode(text.query_map(F.col("q"))).alias("name", "value"))


@query
def leading_ints(spark, sf_dir):
    site = text.query_value(F.col("query_string"), "site")
    client = text.query_value(F.col("query_string"), "c")
    parsed = parse.parse_lines(load_lines(spark, sf_dir))
    return parsed.select(
        "id",
        text.leading_digits(site).alias("site_digits"),
        text.leading_int(site).alias("site_int"),
        text.leading_digits(client).alias("c_digits"),
        text.leading_int(client).alias("c_int"),
    )


@query
def alias_normalise(spark, sf_dir):
    parsed = parse.parse_lines(load_lines(spark, sf_dir))
    return classify.with_parameters(parsed).select("id", "client", "booking", "creative", "site")


@query
def client_ip_norm(spark, sf_dir):
    parsed = parse.parse_lines(load_lines(spark, sf_dir))
    hop = parsed.select("id", netaddr.first_hop(F.col("client_ip")).alias("hop"))
    return netaddr.with_address(hop, "hop", text="ip")


@query
def ip_binary(spark, sf_dir):
    parsed = parse.parse_lines(load_lines(spark, sf_dir))
    hop = parsed.select("id", netaddr.first_hop(F.col("client_ip")).alias("hop"))
    packed = netaddr.with_address(hop, "hop", packed="packed")
    back = netaddr.with_text_of_packed(packed, "packed", "ip")
    return back.select("id", F.lower(F.hex("packed")).alias("packed_hex"), "ip")


@query
def event_times(spark, sf_dir):
    df = parse.parse_lines(load_lines(spark, sf_dir))
    wall = times.wall_clock(F.col("timestamp"))
    moment = F.coalesce(wall, F.col("ingest_time"))
    return df.select(
        "id",
        wall.alias("wall_clock"),
        times.instant(F.col("timestamp")).cast("timestamp_ntz").alias("utc_instant"),
        moment.alias("event_time"),
        (moment - times.days(7)).alias("lookback_start"),
    )


@query
def message_json(spark, sf_dir):
    rows = classify.impressions_of(_touches(spark, sf_dir)).select(
        "id", F.col("event_time").alias("timestmp"), "client_id", "booking_id", "creative_id",
        F.col("ip").alias("ipaddress"), F.col("user_agent").alias("useragent"),
    )
    return rows.select("id", messages.to_message(rows, rows.columns).alias("message"))


@query
def envelope_json(spark, sf_dir):
    """Lines wrapped as JSON and opened again; every fifth envelope is cut short on the way."""
    wrapped = parse.make_envelopes(load_lines(spark, sf_dir)).select("id", "value")
    damaged = F.when(F.col("id") % 5 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    opened = parse.open_envelopes(wrapped.withColumn("value", damaged))
    return opened.select("id", "host", "line_num", F.length("raw").alias("raw_length"))


@query
def line_hash(spark, sf_dir):
    return load_lines(spark, sf_dir).select("id", text.line_hash(F.col("raw")).alias("line_hash"))


# --- classification and validity ----------------------------------------------------------------


def _classified(spark, sf_dir, mode):
    df = classify.classify(parse.parse_lines(load_lines(spark, sf_dir)), mode)
    columns = ["id", "category", "is_valid", "client", "booking", "creative", "site"]
    return classify.where_computed(df.select(*columns), F.col("category").isNotNull())


@query
def classify_lenient(spark, sf_dir):
    return _classified(spark, sf_dir, classify.LENIENT)


@query
def classify_strict(spark, sf_dir):
    return _classified(spark, sf_dir, classify.STRICT)


@query
def valid_impressions(spark, sf_dir):
    return classify.impressions_of(_touches(spark, sf_dir))


@query
def valid_webhits(spark, sf_dir):
    return classify.webhits_of(_touches(spark, sf_dir))


@query
def rejects(spark, sf_dir):
    return classify.rejects_of(_touches(spark, sf_dir))


@query
def rejects_by_reason(spark, sf_dir):
    return rollup.rejects_by_reason(_touches(spark, sf_dir))


@query
def route_counts(spark, sf_dir):
    return rollup.stage_counts(_touches(spark, sf_dir))


@query
def queue_backlog(spark, sf_dir):
    """Routed lines per category after the last one consumed before the saved day."""
    parsed = parse.parse_lines(load_lines(spark, sf_dir))
    entries = parsed.select("id", classify.category_of_path(F.col("path")).alias("category"))
    old = load(spark, sf_dir, "events").where(F.col("ts") < _saved_at())
    consumed = incremental.high_water_mark(old, "event_id", -1)
    return rollup.backlog(entries, consumed)


@query
def peek(spark, sf_dir):
    lines = load_lines(spark, sf_dir).select("id", "host", "line_num", "raw")
    return rollup.peek(lines, 10)


# --- attribution --------------------------------------------------------------------------------


@query
def attribute_causal(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    return attribute.attribute_last_touch(routed.webhits, routed.impressions)


@query
def attribute_causal_split(spark, sf_dir):
    """Causal attribution with almost every key treated as heavy, so that all of them are cut into slices."""
    routed = _routed(spark, sf_dir)
    return attribute.attribute_last_touch(routed.webhits, routed.impressions, heavy_rows=2)


@query
def attribute_unbounded_split(spark, sf_dir):
    """Unbounded attribution with almost every key treated as heavy and spread over parts."""
    routed = _routed(spark, sf_dir)
    return attribute.attribute_last_touch(routed.webhits, routed.impressions, causal=False, heavy_rows=2)


@query
def attribute_unbounded(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    return attribute.attribute_last_touch(routed.webhits, routed.impressions, causal=False)


@query
def attribute_tiered(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    hot, archive = _tiers(routed)
    return attribute.attribute_last_touch(routed.webhits, hot, archive=archive, causal=False)


@query
def attribute_tiered_causal(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    hot, archive = _tiers(routed)
    return attribute.attribute_last_touch(routed.webhits, hot, archive=archive)


@query
def attribute_arrival(spark, sf_dir):
    """Processing order is the line order, processing time the event time."""
    routed = _routed(spark, sf_dir)
    arrived = {"arrival": F.col("id"), "arrived_at": F.col("event_time")}
    hot, archive = _tiers(routed)
    hits = attribute.attribute_by_arrival(
        routed.webhits.withColumns(arrived), hot.withColumns(arrived), archive=archive
    )
    return hits.drop("arrival", "arrived_at")


@query
def unattributed_hits(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    return attribute.unattributed(routed.webhits, routed.impressions)


@query
def latest_impression_per_key(spark, sf_dir):
    return attribute.latest_impression_per_key(classify.impressions_of(_touches(spark, sf_dir)))


@query
def latest_impression_30d(spark, sf_dir):
    """The lookup of one client and address: the pair with the newest impression of all."""
    impressions = _routed(spark, sf_dir).impressions
    newest = impressions.orderBy(F.desc("event_time"), F.desc("id")).select("client_id", "ip").first()
    client_id, ip = (newest["client_id"], newest["ip"]) if newest else (-1, "")
    return attribute.latest_impression(impressions, client_id, ip, AS_OF)


# --- deduplication ------------------------------------------------------------------------------


@query
def accepted_webhits(spark, sf_dir):
    """Flagship: raw lines to attributed hits, one per (impression, site)."""
    return pipeline.accepted_hits(_routed(spark, sf_dir))


@query
def dedupe_first(spark, sf_dir):
    """First hit of each (newest impression, site) under the unbounded rule."""
    return dedupe.dedupe_first(attribute_unbounded(spark, sf_dir))


@query
def dedupe_against_store(spark, sf_dir):
    """Hits since the saved day that no hit stored before it rules out."""
    routed = _routed(spark, sf_dir)
    # Read by the store, by the search for heavy pairs and by the comparison.
    hits = stage(attribute.attribute_last_touch(routed.webhits, routed.impressions), "attributed")
    stored = dedupe.dedupe_first(hits.where(F.col("event_time") < _saved_at()))
    return dedupe.dedupe_against_store(hits.where(F.col("event_time") >= _saved_at()), stored)


@query
def dedupe_greedy(spark, sf_dir):
    return dedupe.dedupe_greedy(attribute_unbounded(spark, sf_dir))


@query
def seen_sites(spark, sf_dir):
    sites = dedupe.seen_sites(accepted_webhits(spark, sf_dir))
    return sites.select("client_id", "ip", F.array_join(F.col("sites").cast("array<string>"), ",").alias("sites"))


@query
def drop_seen_sites(spark, sf_dir):
    """Hits since the saved day whose site their key had not been accepted with before."""
    routed = _routed(spark, sf_dir)
    old = F.col("event_time") < _saved_at()
    seen = routed.webhits.where(old)
    return dedupe.drop_seen(routed.webhits.where(~old), seen)


# --- ids, incremental extraction, upserts -------------------------------------------------------


@query
def numbered_impressions(spark, sf_dir):
    """Impressions with gapless new ids in time order, continuing after 1000."""
    rows = _routed(spark, sf_dir).impressions.withColumnRenamed("id", "event_id")
    numbered = ids.assign_ids(rows, ["event_time", "event_id"], start=1000)
    return numbered.select("id", "event_id", "event_time", "client_id")


def _tables(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    return {"impression": routed.impressions, "webhit": routed.webhits}


def _state(spark, sf_dir):
    """Stored cursors: impressions had been read up to the saved day, webhits never."""
    events = load(spark, sf_dir, "events").where(F.col("ts") < _saved_at())
    return events.agg(
        F.lit("impression").alias("entity_type"),
        F.max("event_id").alias("last_id"),
        _saved_at().alias("updated_at"),
    )


@query
def cursor_bootstrap(spark, sf_dir):
    """First start: no state stored yet."""
    empty = spark.createDataFrame([], PROCESSING_STATE)
    return incremental.load_cursors(empty, incremental.source_maxima(_tables(spark, sf_dir)))


@query
def cursor_resume(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    return incremental.load_cursors(_state(spark, sf_dir), incremental.source_maxima(tables))


@query
def incremental_by_id(spark, sf_dir):
    """Rows of both kinds beyond their cursors, as one stream of new records; lines before both are not read."""
    lines = load_lines(spark, sf_dir)
    cursors = incremental.resumed_cursors(_state(spark, sf_dir), dict.fromkeys(incremental.ENTITIES, lines))
    new = pipeline.touches_of(incremental.incremental_extract(lines, "id", min(cursors.values())))
    mark = F.create_map(*(F.lit(x) for pair in cursors.items() for x in pair))[F.col("category")]
    rows = classify.accepted_of(new, "id", "event_time", "client_id", "ip").where(F.col("id") > mark)
    return rows.select(F.col("category").alias("entity_type"), "id", "event_time", "client_id", "ip")


@query
def extract_marks(spark, sf_dir):
    """Number of new rows and new cursor of each table, observed while the rows are written."""
    tables = _tables(spark, sf_dir)
    cursors = incremental.resumed_cursors(_state(spark, sf_dir), tables)
    made = {
        entity: incremental.write_extract(df, "id", cursors[entity], new_location(spark, f"extract-{entity}"))
        for entity, df in tables.items()
    }
    rows = [(entity, cursors[entity], extract.count, extract.mark) for entity, extract in made.items()]
    return spark.createDataFrame(rows, "entity_type string, last_id bigint, new_rows bigint, new_last_id bigint")


@query
def incremental_by_date(spark, sf_dir):
    daily = rollup.daily_site_hits(_routed(spark, sf_dir).webhits)
    first = F.to_date(F.lit(AS_OF)) - incremental.FIRST_DAYS
    return incremental.incremental_extract(daily, "date", first, inclusive=True)


@query
def keyset_page(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return incremental.incremental_extract(events, "event_id", 99, limit=500)


@query
def high_water_marks(spark, sf_dir):
    """New cursor of each table after an extract, next to the old one."""
    tables = _tables(spark, sf_dir)
    maxima = incremental.source_maxima(tables)
    old = incremental.load_cursors(_state(spark, sf_dir), maxima)
    return maxima.join(old, "entity_type").select(
        "entity_type", "last_id", F.greatest("max_id", "last_id").alias("new_last_id")
    )


@query
def cursor_upsert(spark, sf_dir):
    maxima = incremental.source_maxima(_tables(spark, sf_dir))
    fresh = maxima.select("entity_type", F.col("max_id").alias("last_id"))
    return incremental.save_cursors(_state(spark, sf_dir), fresh, AS_OF)


@query
def daily_site_hits(spark, sf_dir):
    return rollup.daily_site_hits(classify.webhits_of(_touches(spark, sf_dir)))


@query
def daily_impression_hits(spark, sf_dir):
    return rollup.daily_impression_hits(classify.impressions_of(_touches(spark, sf_dir)))


@query
def daily_upsert(spark, sf_dir):
    """Counters as they stood at noon of the saved day, overwritten by the full counts since that day."""
    hits = _routed(spark, sf_dir).webhits
    noon = _saved_at() + F.make_dt_interval(F.lit(0), F.lit(12))
    stored = rollup.daily_site_hits(hits.where(F.col("event_time") < noon))
    fresh = rollup.daily_site_hits(hits.where(F.col("event_time") >= _saved_at()))
    return upsert.upsert(stored, fresh, ["date", "client_id", "sitetag_id"], order_by="hits")


@query
def daily_upsert_table(spark, sf_dir):
    """The same in a stored table: only the days since the saved one are read and written again."""
    hits = _routed(spark, sf_dir).webhits
    noon = _saved_at() + F.make_dt_interval(F.lit(0), F.lit(12))
    path, keys = new_location(spark, "daily-hits"), ["date", "client_id", "sitetag_id"]
    upsert.upsert_table(rollup.daily_site_hits(hits.where(F.col("event_time") < noon)), path, keys, "date", "hits")
    fresh = rollup.daily_site_hits(hits.where(F.col("event_time") >= _saved_at()))
    upsert.upsert_table(fresh, path, keys, "date", "hits")
    return spark.read.schema(fresh.schema).parquet(path)


# --- tailing ------------------------------------------------------------------------------------


def _located(spark, sf_dir):
    return load_lines(spark, sf_dir).select("host", "file", "line_num", "raw", "ingest_time")


def _tail_state(spark, sf_dir):
    """Reading stopped before noon of the saved day; one host was never read."""
    noon = _saved_at() + F.make_dt_interval(F.lit(0), F.lit(12))
    lines = _located(spark, sf_dir)
    read = lines.where((F.col("ingest_time") < noon) & (F.col("host") != "edge8"))
    return tail.tail_state(read, tail.first_lines(lines))


@query
def tail_state(spark, sf_dir):
    return _tail_state(spark, sf_dir)


@query
def resume_tail(spark, sf_dir):
    unread = tail.resume_tail(_located(spark, sf_dir), _tail_state(spark, sf_dir))
    return unread.select("host", "file", "line_num", "raw")


@query
def tail_state_upsert(spark, sf_dir):
    lines = _located(spark, sf_dir)
    reached = tail.tail_state(lines, tail.first_lines(lines))
    return tail.save_tail_state(_tail_state(spark, sf_dir), reached)


@query
def fetch_lines(spark, sf_dir):
    rows = tail.fetch_lines(_located(spark, sf_dir), "edge3", SAVED_DAY_FILE, 1)
    return rows.select("host", "file", "line_num", "raw")


@query
def first_line_hashes(spark, sf_dir):
    return tail.first_lines(_located(spark, sf_dir))


@query
def rotation_events(spark, sf_dir):
    """Every host is polled in each hour it logs; the fingerprint is that of its current file."""
    lines = _located(spark, sf_dir)
    hour = F.make_timestamp_ntz(
        F.year("ingest_time"), F.month("ingest_time"), F.day("ingest_time"), F.hour("ingest_time"),
        F.lit(0), F.lit(0),
    )
    polls = lines.groupBy("host", "file", hour.alias("poll_ts")).agg(F.count("*").alias("n"))
    seen = polls.join(tail.first_lines(lines), ["host", "file"]).select("host", "poll_ts", "first_line_hash")
    return tail.rotation_events(seen)


@query
def latest_rotated_file(spark, sf_dir):
    files = (
        _located(spark, sf_dir)
        .groupBy("host", F.concat(F.lit("/var/log/edge/"), "file").alias("path"))
        .agg(F.max("ingest_time").alias("mtime"))
    )
    return tail.latest_rotated_file(files)


def _log_files(lines: DataFrame, path: str) -> None:
    """Lines (host, file, line_num, raw) as text, one file per host and day as edge servers write them."""
    ordered = lines.repartition("host", "file").sortWithinPartitions("host", "file", "line_num")
    ordered.select("host", "file", "raw").write.partitionBy("host", "file").text(path)


@query
def numbered_lines(spark, sf_dir):
    """All log files, written as text and read back with the number of every line."""
    path = new_location(spark, "log-files")
    _log_files(load_lines(spark, sf_dir), path)
    return logs.read_lines(spark, f"{path}/*/*")


# --- streams ------------------------------------------------------------------------------------


def _event_stream(spark, sf_dir, files_per_batch=None):
    """The events table as a stream of log lines."""
    schema = load(spark, sf_dir, "events").schema
    # As a pattern the path may name one file as well as a folder of part files.
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(f"{sf_dir}/event[s].parquet")
    return lines_from_events(events)


def _drained(stream) -> None:
    stream.awaitTermination()


@query
def stream_route(spark, sf_dir):
    """Envelopes routed to queues by a stream, read back from the queue folders."""
    out, checkpoint = new_location(spark, "queues"), new_location(spark, "queues-checkpoint")
    envelopes = parse.make_envelopes(_event_stream(spark, sf_dir)).select("value")
    _drained(queues.route_stream(envelopes, out, checkpoint))
    routed = spark.read.schema("value string, queue string").text(out)
    entry = messages.read_message(F.col("value"), ENTRY)
    kept = routed.where(F.col("queue") != queues.REJECT_QUEUE).select("queue", entry.alias("e"))
    return kept.select(
        "queue", "e.host", "e.line_num", "e.path", "e.timestamp", "e.client_ip",
        *[F.col(f"e.query.{name}").alias(name) for name in classify.ALIASES],
    )


@query
def stream_bridge(spark, sf_dir):
    """Envelopes moved by a stream; every fifth was cut short and is set aside. Counts per side."""
    out, checkpoint = new_location(spark, "bridge"), new_location(spark, "bridge-checkpoint")
    whole = parse.make_envelopes(_event_stream(spark, sf_dir))
    cut = F.when(F.col("id") % 5 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    _drained(queues.bridge_stream(whole.select(cut.alias("value")), ENVELOPE, out, checkpoint))
    moved = spark.read.schema("value string, queue string").text(out)
    return moved.groupBy("queue").agg(
        F.count("*").alias("messages"), F.sum(F.length("value")).alias("characters")
    )


@query
def stream_rejects(spark, sf_dir):
    """Lines that cannot be used, with the reason, kept by a stream."""
    out, checkpoint = new_location(spark, "rejects"), new_location(spark, "rejects-checkpoint")
    rejected = classify.rejects_of(pipeline.touches_of(_event_stream(spark, sf_dir)))
    writer = rejected.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    _drained(queues.run(writer, True, ""))
    return spark.read.schema(rejected.schema).parquet(out)


@query
def stream_accepted_webhits(spark, sf_dir):
    """The flagship as a stream over stored tables."""
    root, checkpoint = new_location(spark, "tables"), new_location(spark, "tables-checkpoint")
    _drained(attribution.attribution_stream(_event_stream(spark, sf_dir), root, checkpoint))
    return attribution.AttributionTables(root).accepted(spark).drop("event_date", "batch_id")


@query
def stream_interval(spark, sf_dir):
    """Accepted hits of a stream that runs at an interval while lines arrive, merging every second batch."""
    inbox, root, checkpoint = (new_location(spark, name) for name in ("inbox", "interval", "interval-checkpoint"))
    lines = load_lines(spark, sf_dir)
    bounds = ["2000-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2100-01-01"]
    lines.where("false").write.parquet(f"{inbox}/cycle=0")
    tables = attribution.AttributionTables(root, merge_every=2)
    waiting = spark.readStream.schema(lines.schema).parquet(f"{inbox}/cycle=*")
    stream = attribution.attribution_stream(waiting, tables, checkpoint, once=False, interval="1 second")
    try:
        for cycle, (start, end) in enumerate(zip(bounds, bounds[1:]), 1):
            arrived = lines.where(F.expr(f"ingest_time >= timestamp_ntz'{start}' and ingest_time < timestamp_ntz'{end}'"))
            arrived.write.parquet(f"{inbox}/cycle={cycle}")
            stream.processAllAvailable()
    finally:
        stream.stop()
    return tables.accepted(spark).drop("event_date", "batch_id")


@query
def stream_unattributed(spark, sf_dir):
    """Hits without an impression, kept by the stream beside the accepted ones."""
    root, checkpoint = new_location(spark, "tables"), new_location(spark, "tables-checkpoint")
    _drained(attribution.attribution_stream(_event_stream(spark, sf_dir), root, checkpoint))
    return attribution.AttributionTables(root).unattributed(spark).drop("event_date", "batch_id")


def _consumed(spark, sf_dir):
    """Three times a third of the lines arrives, is routed and consumed; every fifth hit is also delivered cut short."""
    inbox, out, root = (new_location(spark, name) for name in ("inbox", "queues", "consumed"))
    routing, consuming = new_location(spark, "queues-checkpoint"), new_location(spark, "consumed-checkpoint")
    carried = StructType([StructField("id", LongType()), StructField("ingest_time", TimestampNTZType())])
    tables = consumers.ConsumedTables(root, carried)
    lines = load_lines(spark, sf_dir)
    bounds = ["2000-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    for cycle, (start, end) in enumerate(zip(bounds, bounds[1:])):
        arrived = lines.where(F.col("ingest_time").between(F.lit(start).cast("timestamp_ntz"), F.expr(f"timestamp_ntz'{end}' - interval 1 microsecond")))
        arrived.write.parquet(f"{inbox}/cycle={cycle}")
        waiting = spark.readStream.schema(lines.schema).parquet(f"{inbox}/cycle=*")
        envelopes = parse.make_envelopes(waiting).select("value", "id", "ingest_time")
        _drained(queues.route_stream(envelopes, out, routing, also=("id", "ingest_time")))
        hits = spark.read.text(f"{out}/queue={queues.WEBHIT_QUEUE}").withColumn("_m", messages.read_message(F.col("value"), carried))
        damaged = hits.where((F.col("_m.id") % 5 == 0) & F.col("_m.ingest_time").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
        damaged.select(F.substring("value", 1, 20).alias("value")).write.mode("append").text(f"{out}/queue={queues.WEBHIT_QUEUE}")
        _drained(consumers.consume_stream(consumers.queued_messages(spark, out), tables, consuming))
    return tables


@query
def stream_consume_queues(spark, sf_dir):
    """Accepted hits of a stream that reads both queues, over several micro-batches."""
    return _consumed(spark, sf_dir).accepted(spark).drop("event_date", "batch_id")


@query
def stream_consume_rejects(spark, sf_dir):
    """Messages of both queues that could not be used, with the reason."""
    return _consumed(spark, sf_dir).rejects(spark).select("queue", "id", "reason")


@query
def stream_replayed_lines(spark, sf_dir):
    """Impressions stored by a stream that gets every line twice, the second time in another order and later."""
    folder = new_location(spark, "replayed")
    lines = load_lines(spark, sf_dir)
    # As many files as keep the cluster busy, in three micro-batches whatever their number.
    parts = (spark.sparkContext.defaultParallelism + 1) // 2
    for times in (3, 2):
        lines.repartition(times * parts, F.xxhash64("id", F.lit(times))).write.mode("append").parquet(folder)
    root, checkpoint = new_location(spark, "tables"), new_location(spark, "tables-checkpoint")
    again = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 2 * parts).parquet(folder)
    with state_store(spark, drain=True):
        _drained(attribution.attribution_stream(replays.once_only(again, horizon="60 days"), root, checkpoint))
    return attribution.AttributionTables(root).impressions(spark).drop("event_date", "batch_id")


@query
def stream_stateful_attribution(spark, sf_dir):
    """Attribution by arrival with keyed state, over one micro-batch in event order."""
    out, checkpoint = new_location(spark, "stateful"), new_location(spark, "stateful-checkpoint")
    rows = classify.accepted_of(
        pipeline.touches_of(_event_stream(spark, sf_dir)),
        "id", "event_time", "client_id", "site_id", "ip",
    )
    hits = stateful.attribute_stateful(stateful.tagged(rows))
    with state_store(spark, drain=True):
        _drained(
            hits.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    return spark.read.schema(hits.schema).parquet(out)


# Ends of the periods in which the lines of the streams below arrive.
ARRIVALS = ("2024-01-11", "2024-01-21", "2100-01-01")


def _arrivals(lines: DataFrame) -> list[DataFrame]:
    """The lines of each period."""
    ends = [F.lit(end).cast("timestamp_ntz") for end in ARRIVALS]
    starts = [F.lit("1900-01-01").cast("timestamp_ntz"), *ends[:-1]]
    return [lines.where((F.col("ingest_time") >= start) & (F.col("ingest_time") < end)) for start, end in zip(starts, ends)]


def _in_phases(spark, sf_dir):
    """Keyed state over three micro-batches, impressions before hits in each. Accepted hits and the checkpoint."""
    inbox, out, checkpoint = (new_location(spark, name) for name in ("inbox", "stateful", "stateful-checkpoint"))
    lines = load_lines(spark, sf_dir)
    for period, arrived in enumerate(_arrivals(lines)):
        arrived.write.parquet(f"{inbox}/period={period}")
        waiting = spark.readStream.schema(lines.schema).parquet(f"{inbox}/period=*")
        rows = classify.accepted_of(pipeline.touches_of(waiting), "id", "event_time", "client_id", "site_id", "ip")
        hits = stateful.attribute_stateful(stateful.tagged(rows), stateful.LastTouch(stateful.PHASES))
        writer = hits.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        with state_store(spark, drain=True):
            _drained(queues.run(writer, True, ""))
    return spark.read.schema(hits.schema).parquet(out), checkpoint


@query
def stream_stateful_phases(spark, sf_dir):
    """Attribution by arrival over three micro-batches: impressions of a batch first, then its hits."""
    return _in_phases(spark, sf_dir)[0]


@query
def stream_state_table(spark, sf_dir):
    """The state that three micro-batches left: last impression of every key and the sites it was credited with."""
    touches = stateful.last_touches(spark, _in_phases(spark, sf_dir)[1])
    return touches.select("client_id", "ip", "impression_id", "impression_time", F.array_join("sites", ",").alias("sites"))


# Times of three polls; the file of the day is called access.log until the day is over.
POLLS = ("2024-01-10 12:00:00", "2024-01-20 12:00:00", "2100-01-01 00:00:00")


@query
def stream_tail_rotation(spark, sf_dir):
    """Every line once, with the poll that found it, over three polls between which files grow and are renamed."""
    inbox, root, checkpoint = (new_location(spark, name) for name in ("polls", "tail", "tail-checkpoint"))
    tables = tailing.TailTables(root)
    lines = load_lines(spark, sf_dir)
    for number, polled in enumerate(POLLS):
        now = F.lit(polled).cast("timestamp_ntz")
        today = F.concat(F.lit("access.log-"), F.date_format(now, "yyyyMMdd"))
        name = F.when(F.col("file") == today, "access.log").otherwise(F.col("file"))
        _log_files(lines.where(F.col("ingest_time") < now).withColumn("file", name), f"{inbox}/poll={number}")
        _drained(tailing.tail_stream(tailing.polled_text(spark, f"{inbox}/*/*/*"), tables, checkpoint))
    return tables.lines(spark).select("host", "line_num", "raw", F.col("batch_id").alias("poll"))
