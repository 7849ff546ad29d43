"""Tails over real files: renamed, replaced, copied, shrunken and empty files, and batches taken in again."""

import pytest

from hitflow.sources.logs import text_blocks
from hitflow.streaming import tailing


def _poll(root, number, **files):
    """Files of host h: name (dots written as __) to lines."""
    folder = root / f"poll={number}" / "host=h"
    folder.mkdir(parents=True)
    for name, lines in files.items():
        (folder / name.replace("__", ".")).write_text("".join(line + "\n" for line in lines))


def _drain(spark, root, tables, checkpoint):
    tailing.tail_stream(tailing.polled_text(spark, f"{root}/*/*"), tables, str(checkpoint)).awaitTermination()


def _lines(spark, tables):
    return sorted((r.batch_id, r.file, r.line_num, r.raw) for r in tables.lines(spark).collect())


@pytest.fixture
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "700")
    yield
    spark.conf.set(name, before)


def test_a_renamed_file_goes_on_and_a_new_one_starts(spark, tmp_path, small_blocks):
    old = [f"old {n} " + "x" * (n % 40) for n in range(1, 101)]
    new = [f"new {n}" for n in range(1, 81)]
    root, tables = tmp_path / "in", tailing.TailTables(str(tmp_path / "out"))
    _poll(root, 0, access__log=old[:60])
    _drain(spark, root, tables, tmp_path / "c")
    # Renamed and grown meanwhile; a new file under its name; an empty one; a copy of the old one.
    _poll(root, 1, access__log=new[:30], access__log_1=old, empty=[], copy=old[:70])
    _drain(spark, root, tables, tmp_path / "c")
    # Nothing new in the old file, which got shorter; two polls in one batch.
    _poll(root, 2, access__log=new[:50], access__log_1=old[:10])
    _poll(root, 3, access__log=new)
    _drain(spark, root, tables, tmp_path / "c")
    expected = [(0, "access.log", n, old[n - 1]) for n in range(1, 61)]
    expected += [(1, "access.log_1", n, old[n - 1]) for n in range(61, 101)] + [(1, "access.log", n, new[n - 1]) for n in range(1, 31)]
    expected += [(2, "access.log", n, new[n - 1]) for n in range(31, 81)]
    assert _lines(spark, tables) == sorted(expected)
    state = {(r.file, r.last_line_num, r.seen_in) for r in tables.state(spark, 2).collect()}
    assert state == {("access.log", 80, 2), ("access.log_1", 100, 2)}


def test_polls_taken_in_again_and_files_forgotten(spark, tmp_path):
    root, tables = tmp_path / "in", tailing.TailTables(str(tmp_path / "out"), remembered=2)
    contents = [["a", "b"], ["a", "b", "c"], ["z"], ["z"], ["a", "b", "c"]]
    for number, lines in enumerate(contents):
        _poll(root, number, f=lines)
        for _ in range(2 if number == 1 else 1):
            tables.poll(text_blocks(spark.read.text(f"{root}/poll={number}/*")), number)
    found = [(b, n, raw) for b, _, n, raw in _lines(spark, tables)]
    assert found == [(0, 1, "a"), (0, 2, "b"), (1, 3, "c"), (2, 1, "z"), (4, 1, "a"), (4, 2, "b"), (4, 3, "c")]
