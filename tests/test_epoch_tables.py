"""The stored upsert: key index, marks, compaction and restarts."""
import datetime as dt

import pytest

from martforge.streaming import upsert_stream as S
from martforge.streaming.epoch_tables import EpochTables

from tests_support import rows

BATCH = "bord int, date date, origin string, aircraft string, altitude int, numbirds int, conditions string"
DAY = dt.date(2023, 6, 24)


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(S, "BUCKETS", 16)
    monkeypatch.setattr(S.flight_bucket, "__defaults__", (16,))


def tables(spark, n=200):
    return {"airports": spark.createDataFrame([(1, "Ohio", None), (2, "unknown", None)], "aid long, airportState string, airportCode string"),
            "flights": spark.createDataFrame([(i, DAY, 1, "Ohio Air", f"A{i}", 100, 0) for i in range(1, n + 1)],
                                             "fid long, date date, origin long, airline string, aircraft string, altitude int, heavy int"),
            "strikes": spark.createDataFrame([(5, 1, 2, "N/A", 0, 10, 1)], "sid long, fid long, numbirds int, impact string, damage int, altitude int, conditions long"),
            "conditions": spark.createDataFrame([(1, "No Cloud"), (2, None)], "cid long, sky_condition string")}


def batch(spark, *items):
    return spark.createDataFrame([(i, DAY, s, a, 10, 1, None) for i, (s, a) in enumerate(items)], BATCH)


def state(spark, root):
    return {k: rows(df) for k, df in S.read_tables(spark, root).items()}


def test_a_batch_reads_only_its_folders_and_no_maximum(spark, tmp_path):
    root = str(tmp_path)
    S.init_tables(tables(spark), root)
    s = S.store(spark, root)
    look_up = S.known_flights(s, S.read_tables(spark, root)["flights"])
    wanted = spark.createDataFrame([(DAY, 1, "A7"), (DAY, 1, "new")], "date date, origin long, aircraft string")
    found = look_up(wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "bucket" in filters
    read = found.inputFiles()
    assert 1 <= found.select("fid").count() < 200 and any(r.fid == 7 for r in found.collect())
    assert len({f for f in read if "bucket=" in f}) > 2  # the table has more folders than were read
    assert S.high_marks(s) == {"airports": 2, "flights": 200, "strikes": 5}
    marks = s.read("marks").where("table = 'flights'")
    assert 8 <= marks.count() <= 16  # one a folder


def test_indexed_upsert_equals_the_plain_one(spark, tmp_path):
    from martforge.operators.upsert import record_strikes
    t, b = tables(spark), batch(spark, ("Ohio", "A3"), ("Utah", "A3"), (None, "A3"), ("Utah", "A3"), ("Ohio", "B"))
    plain = record_strikes(b, t["airports"], t["flights"], t["strikes"], t["conditions"], ["bord"])
    S.init_tables(t, str(tmp_path))
    S.upsert_batch(b, 0, str(tmp_path), ["bord"])
    got = state(spark, str(tmp_path))
    for name in S.GROWING:
        assert got[name] == rows(plain[name].select(*S.read_tables(spark, str(tmp_path))[name].columns))
    # A second batch finds the flights that the first one added.
    S.upsert_batch(batch(spark, ("Utah", "A3"), ("Ohio", "B")), 1, str(tmp_path), ["bord"])
    after = state(spark, str(tmp_path))
    assert after["flights"] == got["flights"] and len(after["strikes"]) == len(got["strikes"]) + 2
    assert S.high_marks(S.store(spark, str(tmp_path)))["strikes"] == 5 + 7


def test_compaction_keeps_rows_and_ids_go_on(spark, tmp_path):
    root = str(tmp_path)
    S.init_tables(tables(spark), root)
    for e in range(5):
        S.upsert_batch(batch(spark, (f"S{e}", "X"), ("Ohio", f"N{e}")), e, root, ["bord"], compact_every=2)
    s = S.store(spark, root)
    assert sorted(s._list("_manifest", r"(-?\d+)\.json")) == [1, 3]
    want = state(spark, root)
    s.vacuum()
    assert s.epochs("strikes") == [4] and sorted(s._list("_manifest", r"(-?\d+)\.json")) == [3]
    assert state(spark, root) == want
    sids = sorted(r[0] for r in S.read_tables(spark, root)["strikes"].select("sid").collect())
    assert sids == list(range(5, 16))
    # A replay of the last epoch replaces its rows, compacted state or not.
    S.upsert_batch(batch(spark, ("S4", "X"), ("Ohio", "N4")), 4, root, ["bord"])
    assert state(spark, root) == want
    S.compact(spark, root, 4)
    s.vacuum()
    assert state(spark, root) == want and s.epochs("strikes") == []
    S.upsert_batch(batch(spark, ("S0", "X")), 5, root, ["bord"])
    assert len(state(spark, root)["flights"]) == len(want["flights"])


def test_a_compaction_that_stops_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    S.init_tables(tables(spark, 20), root)
    for e in range(3):
        S.upsert_batch(batch(spark, ("Utah", f"N{e}")), e, root, ["bord"])
    want = state(spark, root)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # before the manifest
        m.setattr(EpochTables, "_publish", stop)
        with pytest.raises(RuntimeError):
            S.compact(spark, root, 2)
    assert state(spark, root) == want
    assert S.compact(spark, root, 2) is True and state(spark, root) == want
    assert S.compact(spark, root, 2) is False and state(spark, root) == want  # published before
    s = S.store(spark, root)
    deleted = []

    class Half:  # stops in the middle of the deletions
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def delete(self, path, deep):
            if len(deleted) == 3:
                raise RuntimeError("lost")
            deleted.append(path)
            return self.fs.delete(path, deep)

    s._fs = Half(s._fs)
    with pytest.raises(RuntimeError):
        s.vacuum()
    assert state(spark, root) == want
    S.store(spark, root).vacuum()
    assert state(spark, root) == want


def test_empty_tables_and_batches(spark, tmp_path):
    t = {k: df.limit(0) for k, df in tables(spark).items()}
    S.init_tables(t, str(tmp_path))
    S.upsert_batch(spark.createDataFrame([], BATCH), 0, str(tmp_path), ["bord"])
    assert all(v == [] for v in state(spark, str(tmp_path)).values())
    S.upsert_batch(batch(spark, ("Utah", "X")), 1, str(tmp_path), ["bord"])
    got = state(spark, str(tmp_path))
    assert [r[0] for r in got["airports"]] == [1] and [r[0] for r in got["flights"]] == [1] and [r[0] for r in got["strikes"]] == [1]
