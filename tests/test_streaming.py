"""The durable history sink equals the one-pass history, however changes arrive."""

import random

import pytest

from tests.test_history import BASE_SCHEMA, KW, LOG_SCHEMA, D, versions
from vireo.operators.history import scd2_history
from vireo.sources import storage
from vireo.streaming.history_stream import HistorySink, start

BASE = [("M1", "L1", "high", "op", D("2024-01-01")), ("M2", "L2", "low", "op", D("2024-01-01")), ("M3", "L3", "mid", "op", D("2024-06-01"))]
ROWS = [("M1", D("2024-03-04"), "line", "L9"), ("M2", D("2024-05-01"), "crit", "high"),
        ("M2", D("2024-05-01"), "state", "refurb"), ("M3", D("2024-04-01"), "line", "L7"),
        ("M3", D("2024-08-01"), "crit", "low"), ("M2", D("2024-08-01"), "crit", "high"),
        ("M1", D("2024-03-09"), "line", "L2"), ("M1", D("2024-03-09"), "line", "L1")]


@pytest.fixture()
def world(spark, tmp_path):
    base = spark.createDataFrame(BASE, BASE_SCHEMA)
    log = spark.createDataFrame(ROWS, LOG_SCHEMA)
    return base, log, HistorySink(spark, base, str(tmp_path / "history"), **KW), versions(scd2_history(base, log, **KW))


def part(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_one_batch_with_several_dates_of_a_key(world):
    _, log, sink, expected = world
    sink.apply(log, 0)
    assert versions(sink.history()) == expected


@pytest.mark.parametrize("compacted", [(), (0,), (1,), (0, 1, 2)])
def test_batches_in_any_order(spark, world, compacted):
    """Merged on read, after a compaction, and with batches behind one."""
    _, log, sink, expected = world
    rows = ROWS[:]
    random.Random(4).shuffle(rows)
    for i in range(0, len(rows), 3):
        assert sink.append(part(spark, rows[i:i + 3])) == i // 3
        if i // 3 in compacted:
            before = versions(sink.history())
            assert sink.compact() and versions(sink.history()) == before
    assert versions(sink.history()) == expected
    assert sink.compact() == (2 not in compacted) and not sink.compact()
    assert versions(sink.history()) == expected


def test_a_batch_writes_its_own_changes_only(spark, world):
    _, log, sink, _ = world
    sink.append(log)
    sink.compact()
    before = set(storage.listing(spark, f"{sink.root}/data"))
    sink.append(part(spark, ROWS[:1]))
    after = storage.listing(spark, f"{sink.root}/data")
    new = {f[0].rsplit("/", 1)[0] for f in set(after) - before}
    assert before <= set(after) and len(new) == 1
    assert spark.read.parquet(*new).count() == 1


def test_retried_epochs(spark, world):
    _, log, sink, expected = world
    first, second = part(spark, ROWS[:5]), part(spark, ROWS[5:])
    sink.apply(first, 0)
    assert sink.apply(first, 0) is None  # after its commit: nothing happens
    before = versions(sink.history())
    add, sink.commits.add = sink.commits.add, None
    with pytest.raises(TypeError):
        sink.apply(second, 1)  # all is written, then the commit fails
    assert versions(sink.history()) == before
    sink.commits.add = add
    assert sink.apply(second, 1) == 1 and sink.apply(first, 0) is None
    assert versions(sink.history()) == expected
    folders = storage.children(spark, f"{sink.root}/data")
    assert sink.vacuum() > 0 and len(storage.children(spark, f"{sink.root}/data")) < len(folders)
    assert versions(sink.history()) == expected


def test_every_writer_counts_its_own_epochs(spark, world):
    """A job's append and a stream's first batch are both epoch 0, and neither is lost."""
    _, log, sink, expected = world
    assert sink.append(part(spark, ROWS[:3])) == 0
    assert sink.apply(part(spark, ROWS[3:6]), 0) == 0
    assert sink.apply(part(spark, ROWS[6:]), 0, writer="nightly job") == 0
    assert versions(sink.history()) == expected
    assert sink.commits.latest()[1]["writers"] == {"append": 0, "stream": 0, "nightly job": 0}


@pytest.mark.parametrize("late", ["rewrite", "ignore"])
def test_writers_at_the_same_time(spark, world, late, tmp_path):
    """No batch is lost when writers and a compaction meet."""
    from concurrent.futures import ThreadPoolExecutor
    base, log, _, expected = world
    sink = HistorySink(spark, base, str(tmp_path / late), late=late, **KW)
    sink.append(part(spark, ROWS[:1]))
    jobs = [lambda i=i: sink.apply(part(spark, [ROWS[i]]), 0, writer=f"job {i}") for i in range(1, len(ROWS))]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda job: job(), [*jobs[:3], sink.compact, *jobs[3:]]))
    assert len(sink.commits.latest()[1]["writers"]) == len(ROWS)
    if late == "rewrite":
        assert versions(sink.history()) == expected


def test_late_changes_are_ignored_if_asked(spark, world, tmp_path):
    """What reaches the sink after a later change of its key leaves closed versions alone."""
    base, _, _, _ = world
    sink = HistorySink(spark, base, str(tmp_path / "timestamp"), late="ignore", **KW)
    order = [ROWS[6:], ROWS[:3], ROWS[3:6]]
    kept, last = [], {}
    for batch in order:
        taken = [r for r in batch if r[0] not in last or r[1] > last[r[0]]]
        for r in taken:
            last[r[0]] = max(r[1], last.get(r[0], r[1]))
        kept += taken
        sink.append(part(spark, batch))
    assert len(kept) < len(ROWS)
    expected = versions(scd2_history(base, part(spark, kept), **KW))
    assert versions(sink.history()) == expected
    sink.compact()
    sink.append(part(spark, ROWS))
    again = [r for r in ROWS if r[0] not in last or r[1] > last[r[0]]]
    assert versions(sink.history()) == versions(scd2_history(base, part(spark, kept + again), **KW))
    with pytest.raises(ValueError):
        HistorySink(spark, base, str(tmp_path / "x"), late="sometimes", **KW)


def test_earlier_commits_are_read_and_restored(spark, world):
    base, log, sink, expected = world
    sink.append(part(spark, ROWS[:4]))
    first = versions(sink.history())
    sink.append(part(spark, ROWS[4:]))
    sink.compact()
    assert versions(sink.history(as_of=0)) == first and versions(sink.history(as_of=1)) == versions(sink.history(as_of=2)) == expected
    assert sink.restore(0) == 3 and versions(sink.history()) == first
    assert sink.apply(part(spark, ROWS[4:]), 1, writer="append") is None  # undone, not to be applied again
    assert sink.append(part(spark, ROWS[4:])) == 2 and versions(sink.history()) == expected
    assert sink.vacuum(keep=1) > 0 and versions(sink.history()) == expected


def test_empty_batch_and_no_commit(spark, world):
    _, log, sink, expected = world
    assert sink.history() is None and not sink.compact()
    sink.append(log.limit(0))
    sink.append(log)
    sink.append(log.limit(0))
    assert versions(sink.history()) == expected


def test_stream(spark, world, tmp_path):
    _, log, sink, expected = world
    src = str(tmp_path / "changes")
    for rows in (log.limit(3), log.subtract(log.limit(3))):
        rows.write.mode("append").parquet(src)
    start(sink, src, LOG_SCHEMA, str(tmp_path / "ckpt"))
    start(sink, src, LOG_SCHEMA, str(tmp_path / "ckpt"))  # nothing new
    assert versions(sink.history()) == expected


def test_a_fresh_checkpoint_is_another_writer(spark, world, tmp_path):
    """A stream that counts from 0 again loses nothing, and neither does a job beside it."""
    _, log, sink, expected = world
    sink.append(part(spark, ROWS[:2]))
    for name, rows in (("a", ROWS[2:5]), ("b", ROWS[5:])):
        part(spark, rows).write.parquet(str(tmp_path / f"changes-{name}"))
        start(sink, str(tmp_path / f"changes-{name}"), LOG_SCHEMA, str(tmp_path / f"ckpt-{name}"))
    assert versions(sink.history()) == expected
    assert len(sink.commits.latest()[1]["writers"]) == 3
