"""Ids, cursors, upserts, tailing, sources and multi-batch streams."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from hitflow.operators import ids, incremental, parse, tail, upsert
from hitflow.plans.workload import load_lines
from hitflow.schemas import PROCESSING_STATE
from hitflow.sources import logs, queues, staging, tables
from hitflow.streaming import attribution
from hitflow.streaming import queues as stream_queues

SF_DIR = "/root/testdata/sf0.001"
NOW = datetime(2024, 2, 1)


def test_assigned_ids_are_gapless_and_ordered(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("n"))
    rows = ids.assign_ids(df, ["n"], start=50).collect()
    assert sorted((r.n, r.id) for r in rows) == [(n, 51 + n) for n in range(1000)]


def test_replays_are_dropped(spark):
    df = spark.createDataFrame([("h", 1), ("h", 1), ("h", 2)], "host string, line_num bigint")
    assert ids.drop_replays(df, ["host", "line_num"]).count() == 2
    assert ids.hashed_ids(df, ["host", "line_num"]).select("id").distinct().count() == 2


def test_cursors(spark):
    maxima = spark.createDataFrame([("impression", 5000), ("webhit", 400)], "entity_type string, max_id bigint")
    state = spark.createDataFrame([("impression", 77, NOW)], PROCESSING_STATE)
    assert incremental.cursor_values(incremental.load_cursors(state, maxima)) == {"impression": 77, "webhit": 0}
    fresh = incremental.cursor_values(incremental.load_cursors(state.limit(0), maxima))
    assert fresh == {"impression": 4000, "webhit": 0}
    saved = incremental.save_cursors(state, incremental.load_cursors(state, maxima), datetime(2024, 2, 2))
    assert {r.entity_type: r.last_id for r in saved.collect()} == {"impression": 77, "webhit": 0}


def test_extract_is_pushed_to_the_scan(spark, capsys):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    incremental.incremental_extract(events, "event_id", 500).select("event_id").explain()
    plan = capsys.readouterr().out
    assert "GreaterThan(event_id,500)" in plan and "ReadSchema: struct<event_id:bigint>" in plan
    assert incremental.high_water_mark(events.where("event_id < 3"), "event_id", 1) == 2
    assert incremental.high_water_mark(events.limit(0), "event_id", 9) == 9


def test_extract_observes_its_marks_in_the_job_that_writes(spark, tmp_path, capsys):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_id", "user_id")
    top = events.agg(F.max("event_id")).first()[0]
    context = spark.sparkContext
    context.setJobGroup("extract", "extract")
    made = incremental.write_extract(events, "event_id", top - 10, str(tmp_path / "new"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("extract")) == 1
    assert (made.count, made.mark, made.rows.count()) == (10, top, 10)
    none = incremental.write_extract(events, "event_id", top, str(tmp_path / "none"))
    assert (none.count, none.mark, none.rows.count()) == (0, top, 0)


def test_cursors_read_no_source_where_state_is_stored(spark):
    state = spark.createDataFrame([("impression", 77, NOW)], PROCESSING_STATE)
    assert incremental.resumed_cursors(state, dict.fromkeys(incremental.ENTITIES)) == {"impression": 77, "webhit": 0}
    source = spark.range(5001)
    first = incremental.resumed_cursors(state.limit(0), {"impression": source, "webhit": source.limit(0)})
    assert first == {"impression": 4000, "webhit": 0}


def test_incremental_query_reads_newer_lines_only(spark, monkeypatch, capsys):
    from hitflow.plans import queries as plans

    state = spark.createDataFrame([("impression", 700, NOW), ("webhit", 600, NOW)], PROCESSING_STATE)
    monkeypatch.setattr(plans, "_state", lambda *_: state)
    new = plans.QUERIES["incremental_by_id"](spark, SF_DIR)
    new.explain()
    assert "GreaterThan(event_id,600)" in capsys.readouterr().out
    lowest = {r[0]: r[1] for r in new.groupBy("entity_type").agg(F.min("id")).collect()}
    assert lowest["impression"] > 700 and lowest["webhit"] > 600


def test_merged_batches_read_the_same(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("event_time", T.TimestampNTZType())])
    path = str(tmp_path / "t")

    def put(batch_id, *ids_of_days):
        rows = [(i, datetime(2024, 1, d)) for d, i in ids_of_days]
        tables.write_batch(spark.createDataFrame(rows, schema), path, batch_id)

    def seen(days=None):
        return sorted((r.event_date.day, r.id) for r in tables.read_batches(spark, path, schema, days).collect())

    def folders():
        return sorted(int(f.name.partition("=")[2]) for f in (tmp_path / "t").glob("event_date=*/batch_id=*"))

    assert seen() == [] and seen([date(2024, 1, 1)]) == []
    for b in range(4):
        put(b, (1, b), (1 + b % 2, 10 + b))
    before = seen()
    tables.merge_batches(spark, path, schema, 2)
    assert seen() == before and tables.finished_merges(spark, path) == [2]
    assert seen([date(2024, 1, 2), date(2024, 1, 9)]) == [row for row in before if row[0] == 2]
    # A batch behind the merge that runs again replaces its own rows.
    put(3, (1, 3), (2, 13))
    assert seen() == before
    tables.merge_batches(spark, path, schema, 2)
    assert seen() == before
    # A merge that was cut off before its log was written counts for nothing, also when later ones cover more.
    tables.merge_batches(spark, path, schema, 3)
    (tmp_path / "t-merged-log" / "3").unlink()
    assert seen() == before
    put(4, (3, 4))
    tables.merge_batches(spark, path, schema, 4)
    assert seen() == [*before, (3, 4)] and tables.finished_merges(spark, path) == [2, 4]
    put(5, (3, 5))
    tables.merge_batches(spark, path, schema, 5)
    assert seen() == [*before, (3, 4), (3, 5)] and set(folders()) == {5}


def test_attribution_at_an_interval_bounds_its_folders(spark, tmp_path):
    lines = load_lines(spark, SF_DIR)
    inbox, root = str(tmp_path / "in"), str(tmp_path / "t")
    lines.where("false").write.parquet(f"{inbox}/part=0")
    store = attribution.AttributionTables(root, merge_every=2)
    day = F.to_date("ingest_time")
    first = lines.agg(F.min(day)).first()[0]

    def started():
        waiting = spark.readStream.schema(lines.schema).parquet(f"{inbox}/part=*")
        return attribution.attribution_stream(waiting, store, str(tmp_path / "c"), once=False, interval="1 second")

    stream = started()
    for n in range(1, 6):
        days = F.datediff(day, F.lit(first))
        part = lines.where((days >= 6 * (n - 1)) & (days < (6 * n if n < 5 else 10_000)))
        part.write.parquet(f"{inbox}/part={n}")
        stream.processAllAvailable()
        if n == 3:
            stream.stop()
            stream = started()
    stream.stop()
    got = store.accepted(spark).select("id", "impression_id")
    expected = contract.queries()["accepted_webhits"](spark, SF_DIR).select("id", "impression_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert tables.finished_merges(spark, f"{root}/impressions") == [1, 3]
    batches = {int(f.name.partition("=")[2]) for f in (tmp_path / "t" / "impressions").glob("event_date=*/batch_id=*")}
    assert min(batches) >= 2


def test_upsert_last_source_row_wins(spark):
    ddl = "date date, client_id int, sitetag_id int, hits int"
    day = date(2024, 1, 1)
    target = spark.createDataFrame([(day, 1, 1, 5), (day, 2, 2, 6)], ddl)
    source = spark.createDataFrame([(day, 1, 1, 7), (day, 1, 1, 9), (day, 3, 3, 1)], ddl)
    out = upsert.upsert(target, source, ["date", "client_id", "sitetag_id"], order_by="hits")
    assert {(r.client_id, r.hits) for r in out.collect()} == {(1, 9), (2, 6), (3, 1)}
    assert upsert.touched_partitions(target, source.limit(0), "date").count() == 0


def test_upsert_leaves_untouched_partitions_alone(spark, tmp_path):
    ddl, path, keys = "date date, client_id int, hits int", str(tmp_path / "t"), ["date", "client_id"]

    def put(*rows):
        source = spark.createDataFrame([(d and date(2024, 1, d), c, h) for d, c, h in rows], ddl)
        upsert.upsert_table(source, path, keys, "date", "hits")

    def files(day):
        return sorted(f.name for f in (tmp_path / "t" / f"date=2024-01-0{day}").glob("*.parquet"))

    put((1, 1, 5), (2, 1, 6), (None, 1, 7))
    first, second = files(1), files(2)
    for _ in range(2):
        put((2, 1, 9), (2, 2, 1), (3, 1, 2), (2, 2, 4), (None, 2, 8))
    rows = spark.read.schema(ddl).parquet(path).collect()
    expected = {(1, 1, 5), (2, 1, 9), (2, 2, 4), (3, 1, 2), (None, 1, 7), (None, 2, 8)}
    assert {(r.date and r.date.day, r.client_id, r.hits) for r in rows} == expected and len(rows) == len(expected)
    assert first and files(1) == first and files(2) != second and len(files(2)) == 1
    put()
    assert files(1) == first and spark.read.parquet(path).count() == len(expected)
    with pytest.raises(ValueError):
        upsert.upsert_table(spark.createDataFrame([], ddl), path, ["client_id"], "date")


def test_resume_after_rotation(spark):
    lines = spark.createDataFrame(
        [("a", f, n, f"{f}-{n}") for f in ("log-1", "log-2", "log-3") for n in (1, 2, 3)] + [("b", "log-1", 1, "x")],
        "host string, file string, line_num bigint, raw string",
    )
    state = spark.createDataFrame([("a", "log-2", 2, "")], "host string, file string, last_line_num bigint, h string")
    expected = {("a", "log-2", 3), ("a", "log-3", 1), ("a", "log-3", 2), ("a", "log-3", 3), ("b", "log-1", 1)}
    for limit in (100, 0):
        got = tail.resume_tail(lines, state, max_hosts=limit).collect()
        assert {(r.host, r.file, r.line_num) for r in got} == expected


def test_log_files_are_numbered_per_file(spark, tmp_path):
    expected = set()
    for host in ("edge1", "edge2"):
        folder = tmp_path / f"host={host}"
        folder.mkdir()
        texts = [f"{host} line {n} " + "x" * (n % 50) for n in range(1, 2001)]
        (folder / "access.log-1").write_text("\n".join(texts) + "\n")
        expected |= {(host, "access.log-1", n, t) for n, t in enumerate(texts, 1)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = logs.read_lines(spark, f"{tmp_path}/*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.host, r.file, r.line_num, r.raw) for r in rows} == expected and len(rows) == len(expected)
    files = logs.list_files(spark, f"{tmp_path}/*").collect()
    assert {r.host for r in files} == {"edge1", "edge2"}


def test_queue_messages_are_decoded_or_set_aside(spark, tmp_path):
    (tmp_path / "q.json").write_text('{"host":"h","line_num":1,"raw":"x"}\n{broken\n')
    good, bad = queues.decode(queues.read_queue(spark, str(tmp_path)), parse.ENVELOPE)
    assert [tuple(r) for r in good.collect()] == [("h", 1, "x")]
    assert [tuple(r) for r in bad.collect()] == [("{broken", "bad_json")]


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:x", "t")
    assert "partitionColumn" not in plain
    split = tables.jdbc_options("jdbc:x", "t", "id", (0, 100), 8)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "8")


def test_rewriting_a_batch_replaces_only_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id bigint, event_time timestamp_ntz"
    df = spark.createDataFrame([(1, NOW)], schema)
    assert tables.read_batches(spark, path, df.schema).count() == 0
    tables.write_batch(df, path, 0)
    tables.write_batch(spark.createDataFrame([(2, NOW)], schema), path, 1)
    tables.write_batch(spark.createDataFrame([(3, NOW)], schema), path, 1)
    assert {r.id for r in tables.read_batches(spark, path, df.schema).collect()} == {1, 3}


@pytest.fixture(scope="module")
def lines_in_files(spark, tmp_path_factory):
    """Lines in three files, in event order."""
    root = tmp_path_factory.mktemp("lines")
    lines = load_lines(spark, SF_DIR)
    for part, bounds in enumerate([(0, 300), (300, 700), (700, 10**9)]):
        chunk = lines.where((F.col("id") >= bounds[0]) & (F.col("id") < bounds[1]))
        chunk.coalesce(1).write.mode("append").parquet(f"{root}/part={part}")
    return str(root), lines.schema


def test_stream_in_several_batches_equals_batch(spark, tmp_path, lines_in_files):
    root, schema = lines_in_files
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/part=*")
    attribution.attribution_stream(lines, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    accepted = attribution.AttributionTables(str(tmp_path / "t")).accepted(spark)
    expected = contract.queries()["accepted_webhits"](spark, SF_DIR)
    assert accepted.select("batch_id").distinct().count() == 3
    assert {tuple(r) for r in accepted.select(*expected.columns).collect()} == {tuple(r) for r in expected.collect()}


def test_running_a_batch_again_changes_nothing(spark, tmp_path, lines_in_files):
    root, schema = lines_in_files
    store = attribution.AttributionTables(str(tmp_path / "again"))
    for batch_id, part in [(0, 0), (1, 1), (1, 1), (2, 2)]:
        store.apply(spark.read.schema(schema).parquet(f"{root}/part={part}"), batch_id)
    expected = contract.queries()["accepted_webhits"](spark, SF_DIR)
    got = store.accepted(spark).select(*expected.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_interval_stream_keeps_running(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"host":"h","line_num":1,"raw":"x"}\n')
    stream = stream_queues.bridge_stream(
        queues.stream_queue(spark, str(folder), files_per_batch=1), parse.ENVELOPE,
        str(tmp_path / "out"), str(tmp_path / "cp"), once=False, interval="1 second",
    )
    stream.processAllAvailable()
    assert stream.isActive
    stream.stop()
    assert spark.read.text(str(tmp_path / "out")).count() == 1


def test_streams_read_folders_of_part_files(spark, tmp_path):
    """All four streams over a table split into several files, one file per micro-batch where order is free."""
    from hitflow.plans import queries

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    one = "/root/testdata/sf0.001"
    for name in ("stream_route", "stream_bridge", "stream_accepted_webhits"):
        parts, single = (queries.QUERIES[name](spark, d).collect() for d in (str(tmp_path), one))
        assert len(parts) > 0
        assert sorted(map(str, parts)) == sorted(map(str, single)), name
    assert queries.QUERIES["stream_stateful_attribution"](spark, str(tmp_path)).count() > 0


def test_late_batches_accept_no_second_hit(spark, tmp_path):
    """Batches out of order leave one row for each impression and site."""
    from hitflow.plans import queries
    from hitflow.streaming.attribution import AttributionTables

    lines = queries.load_lines(spark, "/root/testdata/sf0.01")
    tables = AttributionTables(str(tmp_path / "tables"))
    days = sorted((r[0] for r in lines.selectExpr("to_date(ingest_time)").distinct().collect()))
    cut = [days[0], days[10], days[20]]
    first, second, third = (lines.where(f"to_date(ingest_time) >= '{a}'" + (f" and to_date(ingest_time) < '{b}'" if b else "")) for a, b in zip(cut, [*cut[1:], None]))
    impressions_first = first.where("raw like '%/impression%' or raw like '%/viewer%'")
    hits = first.subtract(impressions_first)
    late = hits.where("id % 2 = 0")
    for number, batch in enumerate([impressions_first, hits.where("id % 2 = 1"), third, late, second]):
        tables.apply(batch, number)
    accepted = tables.accepted(spark)
    assert accepted.count() > 0
    assert accepted.groupBy("client_id", "ip", "impression_id", "site_id").count().where("count > 1").isEmpty()


def test_staged_tables_leave_no_shuffle_files_and_end_with_their_scratch(spark):
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*.data")}
    folder = lambda table: Path(table.inputFiles()[0].removeprefix("file:")).parent
    before = files()
    with staging.scratch(spark):
        with staging.scratch(spark):
            inner = staging.stage(spark.range(1000).repartition(3, "id"), "inner")
            outer = staging.stage(inner.groupBy("id").count(), "outer", outer=1)
            assert files() <= before
            gone, there = folder(inner), folder(outer)
        assert not gone.exists() and outer.count() == 1000
    assert not there.exists()
