"""Text CSV load (BOM, bracketed names, empty fields), manifest, calendar."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from vireo.functions import temporal as T
from vireo.plans.dims import dim_date, dim_failure_mode, dim_shift
from vireo.sources.tables import Sources
from vireo.sources.text_csv import load_manifest, load_text_csv, read_loaded


def _csv(text):
    d = tempfile.mkdtemp(prefix="vireo-test-")
    p = os.path.join(d, "readings.csv")
    with open(p, "wb") as fh:
        fh.write(text.encode("utf-8-sig"))
    return d, p


def test_text_csv_bom_brackets_empty(spark):
    d, p = _csv("UDI,Air temperature [K],Type\n1,298.1,\n2,,M\n")
    df = load_text_csv(spark, p)
    assert df.columns[:3] == ["UDI", "Air temperature [K]", "Type"]
    assert dict(df.dtypes)["Air temperature [K]"] == "string"
    rows = df.orderBy("UDI").collect()
    assert rows[0]["Type"] is None and rows[1]["Air temperature [K]"] is None
    assert rows[0]["_source_file"] == "readings.csv" and rows[0]["_loaded_at"] is not None
    typed = df.select(F.col("`Air temperature [K]`").cast("decimal(6,1)").alias("t")).collect()
    assert str(typed[0].t) == "298.1"


def test_manifest_all_or_nothing(spark):
    d, p = _csv("a,b\n1,x\n2,y\n")
    root = os.path.join(d, "bronze")
    counts = load_manifest(spark, {"t1": p, "t2": p}, root)
    assert counts == {"t1": 2, "t2": 2}
    assert read_loaded(spark, root, "t1").count() == 2
    try:
        load_manifest(spark, {"t1": p, "bad": os.path.join(d, "missing.csv")}, root)
    except Exception:
        pass
    assert read_loaded(spark, root, "t2").count() == 2  # pointer still on the good version


def test_registry(spark):
    src = Sources(spark, {"x": lambda: spark.range(3)})
    assert src.names() == ["x"] and src["x"].count() == 3
    try:
        src["nope"]
        raise AssertionError
    except KeyError:
        pass


def test_calendar_rules(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 12, 31))], "start date, end date")
    d = {r.date: r for r in dim_date(bounds).filter("date_sk <> -1").collect()}
    assert len(d) == 366
    sun = d[dt.date(2024, 3, 3)]
    assert (sun.day_of_week, sun.day_name, sun.is_workday) == (0, "sunday", False)
    assert d[dt.date(2024, 3, 20)].season == "summer" and d[dt.date(2024, 3, 21)].season == "autumn"
    assert d[dt.date(2024, 12, 20)].season == "spring" and d[dt.date(2024, 12, 21)].season == "summer"
    assert d[dt.date(2024, 2, 29)].date_sk == 20240229 and d[dt.date(2024, 2, 29)].month_name == "february"


def test_shift_and_modes(spark):
    s = {r.shift_name: r for r in dim_shift(spark).collect()}
    assert s["night"].wraps_midnight and not s["morning"].wraps_midnight
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in (0, 5, 6, 13, 14, 21, 22, 23)], "t timestamp")
    assert [r.k for r in ts.select(T.shift_of_hour("t").alias("k")).collect()] == [3, 3, 1, 1, 2, 2, 3, 3]
    assert dim_failure_mode(spark).count() == 7


def test_seed_with_declared_types(spark):
    from vireo.sources.text_csv import load_typed_csv
    d, p = _csv("failure_mode_sk,mode_code\n1,TWF\n2,OSF\n")
    df = load_typed_csv(spark, p, "failure_mode_sk int, mode_code string")
    assert df.dtypes == [("failure_mode_sk", "int"), ("mode_code", "string")]
    assert [tuple(r) for r in df.orderBy("failure_mode_sk").collect()] == [(1, "TWF"), (2, "OSF")]


def test_hash_key_is_portable_and_tells_keys_apart(spark):
    import hashlib

    from vireo.operators.keys import hash_key
    df = spark.createDataFrame([(7, "HOUSEHOLD")], "code bigint, crit string")
    assert df.select(hash_key(["code", "crit"]).alias("h")).first().h == hashlib.sha256(b"1:7|9:HOUSEHOLD").hexdigest()
    odd = [("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("", "a"), ("~", "a"), ("a|1:b", None), (None, None)]
    keys = spark.createDataFrame(odd, "x string, y string").select(hash_key(["x", "y"]).alias("h"))
    assert keys.distinct().count() == len(odd)


def test_csv_as_copy_reads_it(spark):
    """Commas, doubled quotes and line breaks inside quotes; empty fields are null, quoted empty ones are empty texts."""
    d, p = _csv('id,note,code\n1,"said ""hi"", left",a\n2,"two\nlines, one field",""\n3,,"x"\n4,"",\n')
    rows = {r.id: (r.note, r.code) for r in load_text_csv(spark, p).collect()}
    assert rows == {"1": ('said "hi", left', "a"), "2": ("two\nlines, one field", ""), "3": (None, "x"), "4": ("", None)}
    assert load_manifest(spark, {"notes": p}, os.path.join(d, "bronze")) == {"notes": 4}


def test_loaders_at_the_same_time(spark):
    """Both loads commit, one after the other; the later is read and the earlier stays readable."""
    from concurrent.futures import ThreadPoolExecutor

    from vireo.sources.text_csv import loaded_tables
    d, p = _csv("a,b\n1,x\n2,y\n")
    root = os.path.join(d, "bronze")
    with ThreadPoolExecutor(4) as pool:
        assert [c["t"] for c in pool.map(lambda _: load_manifest(spark, {"t": p}, root), range(4))] == [2] * 4
    versions = {loaded_tables(spark, root, n).first().version for n in range(4)}
    assert len(versions) == 4 and loaded_tables(spark, root).first().version in versions
    assert all(read_loaded(spark, root, "t", n).count() == 2 for n in range(4))


def test_rows_are_counted_by_the_write(spark, monkeypatch):
    d, p = _csv("a,b\n1,x\n2,y\n")
    monkeypatch.setattr(type(spark.range(1)), "count", None)
    assert load_manifest(spark, {"t": p}, os.path.join(d, "bronze")) == {"t": 2}


def test_commits_have_a_number_each(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from vireo.sources.storage import CommitLog, create_new
    log = CommitLog(spark, str(tmp_path / "t"))
    assert log.latest() == (-1, None)
    assert log.add(0, {"v": []}) and not log.add(0, {"v": ["lost"]}) and log.latest() == (0, {"v": []})
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: log.update(lambda last: {"v": [*last["v"], i]}), range(24)))
    assert sorted(numbers) == list(range(1, 25)) and sorted(log.latest()[1]["v"]) == list(range(24))
    assert create_new(spark, f"{log.folder}/{25:012d}.json", "")  # a writer that died before it wrote
    assert log.latest()[0] == 24
    assert log.update(lambda last: {"v": len(last["v"])}) == 26 and log.latest() == (26, {"v": 24})
    assert log.update(lambda last: None) is None
    log.forget_before(26)
    assert log.numbers() == [26]


def test_no_scratch_folder_off_local_masters():
    import pytest

    from vireo.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_key, default=None):
                return default
    with pytest.raises(ValueError):
        checkpoint_dir(Session())
