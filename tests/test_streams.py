"""Queue consumers, replays and scratch tables."""

import json
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hitflow.session import state_store
from hitflow.sources import staging
from hitflow.streaming import consumers, queues, replays

START = datetime(2024, 3, 1)


def _message(minute, path, line_num=1, **query):
    entry = {name: "x" for name in ("edge_ip", "method", "query_string", "status", "user_agent", "referer")}
    stamp = (START + timedelta(minutes=minute)).isoformat() + "+00:00"
    return json.dumps({**entry, "timestamp": stamp, "path": path, "client_ip": "10.0.0.1", "host": "h", "line_num": line_num, "query": query})


def _put(root, queue, name, lines):
    folder = root / f"queue={queue}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def _imp(minute, **more):
    return _message(minute, "/impression", **{"client": "1", "booking": "2", "creative": "3", **more})


def _hit(minute, **more):
    return _message(minute, "/client", **{"client": "1", "site": "4", **more})


def test_consumers_credit_over_batches_and_keep_the_rest(spark, tmp_path):
    root, tables = tmp_path / "q", consumers.ConsumedTables(str(tmp_path / "t"))
    checkpoint = str(tmp_path / "c")

    def drain():
        waiting = consumers.queued_messages(spark, str(root), hit_files_per_batch=1)
        consumers.consume_stream(waiting, tables, checkpoint).awaitTermination()

    # Only hits so far: the impression folder does not exist yet.
    _put(root, queues.WEBHIT_QUEUE, "a.json", [_hit(1), "{cut", "", "[1]"])
    drain()
    assert tables.accepted(spark).count() == 0 and tables.unattributed(spark).count() == 1
    _put(root, queues.IMPRESSION_QUEUE, "a.json", [_imp(10), _imp(11, booking="x"), _hit(12)])
    _put(root, queues.WEBHIT_QUEUE, "b.json", [_hit(20), _hit(20), _hit(25), _hit(20, site="-"), _hit(20, client="")])
    drain()
    _put(root, queues.IMPRESSION_QUEUE, "b.json", [_imp(30)])
    # Delivered again, and one hit of the new impression.
    _put(root, queues.WEBHIT_QUEUE, "c.json", [_hit(20), _hit(31)])
    drain()
    accepted = tables.accepted(spark).orderBy("event_time").collect()
    assert [(r.event_time, r.impression_time) for r in accepted] == [
        (START + timedelta(minutes=m), START + timedelta(minutes=i)) for m, i in ((20, 10), (31, 30))
    ]
    reasons = sorted((r.queue, r.reason) for r in tables.rejects(spark).collect())
    assert reasons == sorted([
        (queues.WEBHIT_QUEUE, "bad_json"), (queues.WEBHIT_QUEUE, "bad_json"), (queues.WEBHIT_QUEUE, "bad_json"),
        (queues.IMPRESSION_QUEUE, "bad_id"), (queues.IMPRESSION_QUEUE, "missing_key"),
        (queues.WEBHIT_QUEUE, "bad_site"), (queues.WEBHIT_QUEUE, "bad_id"),
    ])


def test_consuming_a_batch_again_changes_nothing(spark, tmp_path):
    tables = consumers.ConsumedTables(str(tmp_path / "t"))
    rows = [(queues.IMPRESSION_QUEUE, _imp(1)), (queues.WEBHIT_QUEUE, _hit(2)), (queues.WEBHIT_QUEUE, "{"), (queues.WEBHIT_QUEUE, None)]
    batch = spark.createDataFrame(rows, "queue string, value string")
    for _ in range(2):
        tables.consume(batch, 0)
    assert tables.accepted(spark).count() == 1 and tables.impressions(spark).count() == 1 and tables.rejects(spark).count() == 2


def test_replayed_lines_pass_once_and_state_forgets(spark, tmp_path):
    """A file a day, each also holding all lines of the day before; the horizon is two days."""
    schema = "host string, file string, line_num bigint, ingest_time timestamp_ntz"
    days = [[("h", "f", 100 * d + i, START + timedelta(days=d, hours=i)) for i in range(10)] for d in range(8)]
    folder, out = tmp_path / "in", str(tmp_path / "out")
    sizes = []
    for d, rows in enumerate(days):
        again = [(h, f, n, t + timedelta(days=1)) for h, f, n, t in days[d - 1]] if d else []
        spark.createDataFrame(rows + again, schema).coalesce(1).write.mode("append").parquet(str(folder))
        lines = spark.readStream.schema(schema).parquet(str(folder))
        with state_store(spark):
            stream = (
                replays.once_only(lines, horizon="2 days").writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            )
            stream.awaitTermination()
        sizes.append(stream.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted(r.line_num for r in spark.read.schema(schema).parquet(out).collect())
    assert got == sorted(n for rows in days for _, _, n, _ in rows)
    # State grows to the lines of the horizon, not to all of them.
    assert max(sizes) <= 50 < len(got) and sizes[-1] <= max(sizes[:4])


def test_scratch_tables_are_removed(spark):
    df = spark.range(5)
    kept = staging.stage(df, "kept")
    with staging.scratch(spark):
        gone = staging.stage(df.where(F.col("id") > 1), "gone")
        assert gone.count() == 3
    folder = [f.removeprefix("file:") for f in gone.inputFiles()][0].rsplit("/", 1)[0]
    assert not os.path.exists(folder.removeprefix("//")) and kept.count() == 5
