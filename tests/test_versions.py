import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from areapulse.schemas import DIM_SPATIAL, GOLD_ACTIVITY, GOLD_DEMOGRAPHICS
from areapulse.sources import versions
from areapulse.sources.ingest import IngestStore
from areapulse.sources.measures import MeasureStore
from areapulse.sources.staging import Gold

TELCO = "CRTR_YM,DAY_CNT,VST_SGG_CD,ML_VST_PPLTN_1,FM_VST_PPLTN_1\n"


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(TELCO + "".join(f"{line}\n" for line in lines))
    return str(folder)


def months(store, replace=False):
    return store._state(replace).version().parts.get("activity", {})


def test_a_month_that_grows_leaves_the_files_of_others(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", "202401,1,11680,3,4", "202402,1,11680,5,0")
    store = IngestStore(spark, str(tmp_path / "store"))
    store.ingest("telco", [folder], "*.csv")
    assert store.refresh() > 0 and store.refresh() == 0
    before = months(store)
    assert set(before) == {"2024-01", "2024-02"}
    opened = store.activity()
    put(tmp_path / "in", "b.csv", "202402,1,11680,1,1", "202403,1,11680,2,0")
    store.ingest("telco", [folder], "*.csv")
    # added up on the fly until the next refresh
    assert rows(store.activity(), "date", "foot_traffic") == [(dt.date(2024, 1, 1), 7.0), (dt.date(2024, 2, 1), 7.0), (dt.date(2024, 3, 1), 2.0)]
    store.refresh()
    after = months(store)
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"] and "2024-03" in after
    assert rows(store.activity(), "foot_traffic") == [(2.0,), (7.0,), (7.0,)]
    assert rows(opened, "foot_traffic") == [(5.0,), (7.0,)]
    plan = store.activity()._jdf.queryExecution().toString()
    assert "Aggregate" not in plan


def test_a_refresh_that_dies_before_its_publication_changes_nothing(spark, rows, tmp_path, monkeypatch):
    folder = put(tmp_path / "in", "a.csv", "202401,1,11680,3,4")
    store = IngestStore(spark, str(tmp_path / "store"))
    store.ingest("telco", [folder], "*.csv")
    store.refresh()
    before = months(store)
    put(tmp_path / "in", "b.csv", "202401,1,11680,10,0")
    store.ingest("telco", [folder], "*.csv")

    def dies(self, base, changes):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(versions.VersionedTables, "publish", dies)
        with pytest.raises(OSError):
            store.refresh()
    assert months(store) == before
    assert rows(store.activity(), "foot_traffic") == [(17.0,)]
    store.refresh()
    assert rows(store.activity(), "foot_traffic") == rows(store._state(False).read("activity", GOLD_ACTIVITY), "foot_traffic") == [(17.0,)]


def test_a_replaced_file_is_taken_out_of_its_months(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", "202401,1,11680,3,4", "202402,1,11680,1,0")
    put(tmp_path / "in", "b.csv", "202401,1,11680,10,0", "202405,1,11680,1,0")
    store = IngestStore(spark, str(tmp_path / "store"))
    store.ingest("telco", [folder], "*.csv")
    store.refresh(replace=True)
    before = months(store, True)
    put(tmp_path / "in", "a.csv", "202403,1,11680,100,50")
    store.ingest("telco", [folder], "*.csv")
    want = [(dt.date(2024, 1, 1), 10.0), (dt.date(2024, 3, 1), 150.0), (dt.date(2024, 5, 1), 1.0)]
    assert rows(store.activity(replace=True), "date", "foot_traffic") == want
    store.refresh(replace=True)
    assert rows(store.activity(replace=True), "date", "foot_traffic") == want
    after = months(store, True)
    assert set(after) == {"2024-01", "2024-03", "2024-05"} and after["2024-05"] == before["2024-05"]
    assert rows(store.activity(), "foot_traffic") == [(1.0,), (1.0,), (150.0,), (17.0,)]
    store.compact(replace=True)
    store.refresh(replace=True)
    assert rows(store.activity(replace=True), "date", "foot_traffic") == want


def test_only_one_of_two_writers_publishes(spark, rows, tmp_path):
    tables = versions.VersionedTables(spark, str(tmp_path / "t"))
    frame = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "p string, n int")
    base = tables.version()
    first = tables.publish(base, {"t": tables.write("t", frame, "p")})
    with pytest.raises(versions.ConcurrentPublication):
        tables.publish(base, {"t": tables.write("t", frame, "p")})
    schema = frame.select("n").schema
    assert rows(tables.read("t", schema)) == [(1,), (2,), (3,)]
    assert rows(tables.read("t", schema, parts=["x", "absent"])) == [(1,)]
    tables.publish(first, {"t": {"x": None}})
    assert rows(tables.read("t", schema)) == [(2,), (3,)] and rows(tables.read("t", schema, first)) == [(1,), (2,), (3,)]
    assert tables.forget(keep=1) == 1 and tables.numbers() == [2]
    assert rows(tables.read("t", schema)) == [(2,), (3,)]


def gold_of(spark, facts):
    dim = [(k, f"L{k}", "emd", f"{c}00000", *[None] * 8) for k, c in (("a", "00001"), ("b", "00001"), ("c", "00002"))]
    line = [(k, dt.date(2024, m, 1), "month", "s", float(f), float(s), None) for k, m, f, s in facts]
    return Gold(
        spark.createDataFrame(line, GOLD_ACTIVITY), spark.createDataFrame([], GOLD_DEMOGRAPHICS), spark.createDataFrame(dim, DIM_SPATIAL),
        spark.createDataFrame([("00001", "one", "1", "north"), ("00002", "two", "2", "south")], "sig_code string, sig_name string, sido_code string, sido_name string"),
        None,
    )


def test_measures_of_touched_labels_are_refreshed(spark, rows, tmp_path):
    facts = [(k, m, m * n + m % 3, m * m + n) for n, k in enumerate("abc", 1) for m in range(1, 6)]
    early, late = gold_of(spark, facts), gold_of(spark, [*facts, ("a", 6, 50, 1)])
    store, whole = (MeasureStore(spark, str(tmp_path / name)) for name in ("store", "whole"))
    store.refresh(early)
    opened, before = store.read(), store.tables.version().parts["advanced"]
    changed = spark.createDataFrame([("a",)], "spatial_key string")
    labels, keys = store.touched(late, changed)
    assert rows(labels) == [("norm", "La"), ("sido", "north"), ("sig", "one")] and rows(keys) == [("a",), ("b",)]
    old = rows(opened)
    store.refresh(late, changed)
    whole.refresh(late)
    assert rows(store.read(), "level", "spatial_label", F.round("sales_impact_slope", 9)) == rows(whole.read(), "level", "spatial_label", F.round("sales_impact_slope", 9))
    assert rows(opened) == old != rows(store.read())
    after = store.tables.version().parts["advanced"]
    assert 1 <= sum(before[b] != after[b] for b in before) <= 3
    store.refresh(replace(late, activity=late.activity.where("spatial_key <> 'c'")), spark.createDataFrame([("c",)], "spatial_key string"))
    assert not [r for r in rows(store.read()) if r[1] in ("Lc", "two", "south")]
