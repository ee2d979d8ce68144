import datetime as dt

import pytest
from pyspark.sql import functions as F

from areapulse.operators import normalize as norm
from areapulse.schemas import GOLD_ACTIVITY
from areapulse.sources import files, lake, upserts
from areapulse.sources.ingest import IngestStore
from areapulse.streaming.ingest import stream_files

D = dt.date
TELCO = "CRTR_YM,DAY_CNT,VST_SGG_CD,ML_VST_PPLTN_1,FM_VST_PPLTN_1\n"


def put(folder, name, text, bom=False):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(("﻿" if bom else "") + text, encoding="utf-8")
    return str(folder)


def test_scan_skips_missing_folders_and_reads_bars_and_marks(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", TELCO.replace(",", "|") + "202401|1|11680|3|4\n", bom=True)
    paths = files.collect_files(spark, [folder, str(tmp_path / "absent")], ["*.csv"])
    assert len(paths) == 1 and [r["columns"][0] for r in files.layouts(files.listing(spark, paths)).collect()] == ["CRTR_YM"]
    got = norm.telco(files.read_csv(spark, paths)).activity
    assert rows(got, "spatial_key", "date", "foot_traffic") == [("11680", D(2024, 1, 1), 7.0)]
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, [])


def test_heads_are_two_kilobytes_and_quoted_headers_may_break(spark, rows, tmp_path, monkeypatch):
    folder = put(tmp_path / "in", "a.csv", 'CRTR_YM,"DAY\nCNT",VST_SGG_CD,ML_VST_PPLTN_1\n202401,1,11680,3\n', bom=True)
    # the first line alone looks like commas
    put(tmp_path / "in", "b.csv", "CRTR_YM|a,b|VST_SGG_CD|ML_VST_PPLTN_1\n202401|1|11680|10\n202401|2|11680|20\n")
    put(tmp_path / "in", "c.csv", ",".join(["CRTR_YM,VST_SGG_CD"] + [f"ML_VST_PPLTN_{i:040}" for i in range(90)]) + "\n202401,11680" + ",1" * 90 + "\n" + "202402,1\n" * 5000)
    listed = files.list_files(spark, [folder], "*.csv")
    heads = {r["path"][-5:]: r["head"] for r in files.heads(listed).collect()}
    assert len(heads["c.csv"].encode()) == 3 * files.SAMPLE_BYTES
    found = {r["path"][-5:]: r for r in files.layouts(listed).collect()}
    assert found["a.csv"]["columns"] == ["CRTR_YM", "DAY\nCNT", "VST_SGG_CD", "ML_VST_PPLTN_1"] and found["a.csv"]["lines"] == 2
    assert (found["b.csv"]["sep"], len(found["b.csv"]["columns"]), len(found["c.csv"]["columns"])) == ("|", 4, 92)
    store = IngestStore(spark, str(tmp_path / "store"))
    assert store.ingest("telco", [folder], "*.csv") == 3
    assert rows(store.activity().where("spatial_key = '11680'"), "foot_traffic") == [(123.0,)]


def test_layouts_of_odd_heads():
    assert files.layout_of("") is None and files.layout_of("\n a,b\n") is None
    assert files.layout_of('a"b,c\nd,e\n').columns == ('a"b', "c")
    assert files.layout_of("a;b;c").sep == ";"


def test_unclear_delimiters(spark):
    assert files.detect_delimiter([]) == ","
    assert files.detect_delimiter(["a|b", "c|d"]) == "|"
    assert files.detect_delimiter(["word"]) == ","


def test_same_files_twice_change_nothing_and_a_changed_file_adds_or_replaces(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", TELCO + "202401,1,11680,3,4\n")
    put(tmp_path / "in", "b.csv", TELCO + "202401,1,11680,10,0\n202402,1,nan,1,1\n")
    store = IngestStore(spark, str(tmp_path / "store"))
    assert store.ingest("telco", [folder], "*.csv") == 2
    assert store.ingest("telco", [folder], "*.csv") == 0
    assert rows(store.activity(), "spatial_key", "foot_traffic") == [("11680", 17.0)]
    put(tmp_path / "in", "b.csv", TELCO + "202401,1,11680,100,50\n")
    assert store.ingest("telco", [folder], "*.csv") == 1
    assert rows(store.activity(), "foot_traffic") == [(167.0,)]
    assert rows(store.activity(replace=True), "foot_traffic") == [(157.0,)]
    assert rows(store.spatial(), "spatial_key", "spatial_label") == [("11680", "11680")]
    store.compact()
    assert rows(store.activity(), "foot_traffic") == [(167.0,)]
    assert rows(store.committed(replace=False), "batch_id")[0][0].startswith("compact-")
    put(tmp_path / "in", "c.csv", TELCO + "202401,1,11680,1,0\n")
    assert store.ingest("telco", [folder], "*.csv") == 1
    assert rows(store.activity(), "foot_traffic") == [(168.0,)]
    assert rows(store.spatial(), "spatial_key", "spatial_label") == [("11680", "11680")]


def test_compaction_can_drop_earlier_versions(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", TELCO + "202401,1,11680,3,4\n")
    store = IngestStore(spark, str(tmp_path / "store"))
    store.ingest("telco", [folder], "*.csv")
    put(tmp_path / "in", "a.csv", TELCO + "202401,1,11680,100,50\n")
    store.ingest("telco", [folder], "*.csv")
    store.compact(replace=True)
    assert rows(store.activity(), "foot_traffic") == rows(store.activity(replace=True), "foot_traffic") == [(150.0,)]


def test_rows_of_a_run_that_did_not_commit_are_not_read(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", TELCO + "202401,1,11680,3,4\n")
    store = IngestStore(spark, str(tmp_path / "store"))
    raw = files.read_csv(spark, files.collect_files(spark, [folder], ["*.csv"]))
    store.write_delta("telco-dead", norm.telco(raw, keep=("source_file",)))
    assert rows(store.activity()) == []
    store.ingest("telco", [folder], "*.csv")
    assert rows(store.activity(), "foot_traffic") == [(7.0,)]


def test_files_of_any_layout_are_read_by_name_and_bad_ones_do_not_block(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", TELCO + "202401,1,11680,3,4\n")
    put(tmp_path / "in", "b.csv", TELCO.replace(",", "|") + "202401|1|11680|10|0\n", bom=True)
    put(tmp_path / "in", "c.csv", "VST_SGG_CD,ML_VST_PPLTN_1,FM_VST_PPLTN_1,CRTR_YM,DAY_CNT\n11680,100,0,202401,1\n")
    put(tmp_path / "in", "d.csv", "CRTR_YM,DAY_CNT,VST_SGG_CD,ML_VST_PPLTN_1,FM_VST_PPLTN_1,FM_VST_PPLTN_2\n202401,1,11680,0,0,1000\n")
    put(tmp_path / "in", "e.csv", "nothing,of,this\n1,2,3\n")
    put(tmp_path / "in", "f.csv", "")
    store = IngestStore(spark, str(tmp_path / "store"))
    assert rows(store.unreadable("telco", [folder], "*.csv").withColumn("path", F.substring_index("path", "/", -1)), "path")[:1] == [("e.csv",)]
    assert store.ingest("telco", [folder], "*.csv") == 4
    assert rows(store.activity(), "spatial_key", "foot_traffic") == [("11680", 1117.0)]
    assert store.ingest("telco", [folder], "*.csv") == 0


def test_stream_and_batches_share_the_log(spark, rows, tmp_path):
    folder = put(tmp_path / "in", "a.csv", TELCO + "202401,1,11680,3,4\n")
    store = IngestStore(spark, str(tmp_path / "store"))

    def run(state="state"):
        stream_files(store, "telco", folder, "*.csv", str(tmp_path / state)).awaitTermination()
        return rows(store.activity(), "foot_traffic")

    assert run() == run() == run("fresh") == [(7.0,)]
    put(tmp_path / "in", "b.csv", "VST_SGG_CD,FM_VST_PPLTN_1,ML_VST_PPLTN_1,CRTR_YM,DAY_CNT\n11680,1,1,202401,1\n")
    assert run() == [(9.0,)]
    assert store.ingest("telco", [folder], "*.csv") == 0
    assert rows(store.spatial(), "spatial_key", "spatial_label") == [("11680", "11680")]
    put(tmp_path / "in", "b.csv", TELCO + "202401,1,11680,50,50\n")
    assert run() == [(9.0,)] and run("changed") == [(109.0,)]
    assert rows(store.activity(replace=True), "foot_traffic") == [(107.0,)]


def test_sales_row_of_a_known_case(spark, rows):
    raw = spark.createDataFrame(
        [("202506", "강남구", "카페", "1000", "500", "10", "5"), ("202506", "nan", "카페", "1", "1", "1", "1")],
        "STD_YM string, SGG_NAME string, SCLS_NM string, MAN_SALE_AMT_10G string, WMAN_SALE_AMT_20G string, "
        "MAN_APV_CNT_10G string, WMAN_APV_CNT_40G string",
    )
    got = norm.sales(raw)
    assert rows(got.activity, "spatial_key", "date", "source", "sales", "sales_count", "foot_traffic") == [
        ("강남구", D(2025, 6, 1), "sales", 1500.0, 15.0, None)]
    assert rows(got.spatial) == [("강남구", "강남구", None, None, None, None)]


def test_cells_without_coordinates_have_none(spark, rows):
    raw = spark.createDataFrame(
        [("202401", "1", "127.5", "NaN", "2", "x"), ("202401", "2", "127.5", "37.5", "1", "1"), ("202401", "", "1", "1", "1", "1")],
        "STD_YM string, HCODE string, X_COORD string, Y_COORD string, M_0009 string, w_70U string",
    )
    got = norm.city_cell_sex_age(raw)
    assert rows(got.spatial, "spatial_key", "spatial_type", "lat", "lon") == [("1", None, None, None), ("2", "coord", 37.5, 127.5)]
    assert rows(got.demographics, "spatial_key", "sex", "age_group", "value") == [
        ("1", "female", "70U", 0.0), ("1", "male", "0009", 2.0), ("2", "female", "70U", 1.0), ("2", "male", "0009", 1.0)]
    assert rows(got.activity, "spatial_key", "foot_traffic") == [("1", 2.0), ("2", 2.0)]


def test_files_are_routed_by_name(spark):
    names = ["sungnam_service_pcell_sex_age_pop_1.csv", "SUNGNAM_SERVICE_PCELL_POP.CSV", "sungnam_unique_pop_2.csv", "other.csv"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in frame.select(norm.detect_table(F.col("n"))).collect()] == ["pcell_sex_age", "pcell", "unique", None]


def test_lake_layers_append(spark, rows, tmp_path):
    frame = spark.createDataFrame([("202401", 1.0), ("bad", 2.0)], "m string, v double")
    for file_format in ("parquet", "csv"):
        for _ in range(2):
            lake.write_layer(norm.bronze(frame, F.col("m")), str(tmp_path), "bronze", f"d_{file_format}", file_format)
        assert lake.read_layer(spark, str(tmp_path), "bronze", f"d_{file_format}", file_format).count() == 2
    with pytest.raises(ValueError):
        lake.layer_path("r", "gold", "d")


def test_a_repeated_batch_replaces_its_rows(spark, rows, tmp_path):
    write = lambda v, batch: lake.write_layer(norm.bronze(spark.createDataFrame([("202401", v)], "m string, v double"), F.col("m")), str(tmp_path), "bronze", "d", batch=batch)
    for value, batch in ((1.0, "a"), (2.0, "b"), (3.0, "a")):
        write(value, batch)
    assert rows(lake.read_layer(spark, str(tmp_path), "bronze", "d"), "v") == [(2.0,), (3.0,)]


def test_a_domain_of_ones_own_is_ingested(spark, rows, tmp_path):
    def bikes(df, granularity="month", keep=()):
        read = norm.Normalised if hasattr(norm, "Normalised") else None
        assert read is None or granularity == "month"
        return norm.telco(df.withColumnsRenamed({"month": "CRTR_YM", "station": "VST_SGG_CD", "rides": "ML_VST_PPLTN_1"}), granularity, keep)

    norm.register("bikes", bikes, "bikes_*.csv")
    try:
        put(tmp_path / "in", "bikes_1.csv", "month,station,rides\n202401,s1,5\n")
        store = IngestStore(spark, str(tmp_path / "store"))
        assert store.ingest("bikes", [str(tmp_path / "in")]) == 1
        assert rows(store.activity(), "spatial_key", "foot_traffic") == [("s1", 5.0)]
        with pytest.raises(ValueError):
            norm.register("bikes", bikes, "x")
    finally:
        norm.unregister("bikes")


def test_added_measures_stay_unknown_where_nobody_set_them(spark, rows):
    old = spark.createDataFrame([("a", D(2024, 1, 1), "month", "s", 1.0, None, None)], GOLD_ACTIVITY)
    new = spark.createDataFrame([("a", D(2024, 1, 1), "month", "s", 2.0, None, None), ("b", D(2024, 1, 1), "month", "s", None, 5.0, 1.0)], GOLD_ACTIVITY)
    assert rows(upserts.add_activity(old, new), "spatial_key", "foot_traffic", "sales") == [("a", 3.0, None), ("b", None, 5.0)]


def test_known_places_win_and_the_last_row_of_a_batch_counts(spark, rows):
    columns = "spatial_key string, spatial_label string, spatial_type string, code string, lat double, lon double"
    names = ["emd_code", "emd_name", "sig_code", "sig_name", "sido_code", "sido_name"]
    dim = spark.createDataFrame([("a", "A", None, None, 1.0, None)], columns).withColumns({n: F.lit(None).cast("string") for n in names})
    batch = spark.createDataFrame(
        [("a", "x", "coord", "1", 9.0, 9.0, 1), ("a", "y", "coord", None, 8.0, 8.0, 2), ("b", "B", None, None, None, None, 1)], columns + ", pos int")
    got = upserts.fill_spatial(dim, upserts.last_per_key(batch, "pos"))
    assert rows(got, "spatial_key", "spatial_label", "spatial_type", "code", "lat", "lon") == [
        ("a", "A", "coord", None, 1.0, 8.0), ("b", "B", None, None, None, None)]


def test_frames_with_other_columns_are_concatenated_by_name(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([("y",)], "s string")
    assert rows(files.concat([a, b]), "n", "s") == [(1, "x"), (None, "y")]


def test_sums_of_both_fact_tables_are_stored_once(spark, rows, tmp_path):
    names = ["STD_YM", "HCODE", "X_COORD", "Y_COORD", "M_0009", "W_0009"]
    raw = spark.createDataFrame([("202401", "1", "127", "37", "1", "2"), ("202401", "1", "126", "38", "3", "x"), ("202402", "2", None, "37", "1", "1")],
                                ", ".join(f"{n} string" for n in names))
    made, stored = norm.city_cell_sex_age(raw), []

    def store(sums):
        sums.write.parquet(str(tmp_path / f"sums{len(stored)}"))
        stored.append(spark.read.parquet(str(tmp_path / f"sums{len(stored)}")))
        return stored[-1]

    kept = made.stored(store)
    assert len(stored) == 1
    for table in ("activity", "demographics"):
        assert set(getattr(kept, table).inputFiles()) == set(stored[0].inputFiles())
        assert rows(getattr(kept, table)) == rows(getattr(made, table))
    assert rows(made.spatial, "spatial_key", "lat", "lon") == [("1", 38.0, 126.0), ("2", None, None)]


def test_drops_of_large_tables_are_written_by_several_tasks(spark, monkeypatch, tmp_path):
    from areapulse.checks import ingest_checks

    raw = spark.createDataFrame([(ym, "1") for ym in ("199301", "199401", "199601", "199801") for _ in range(4)], "CRTR_YM string, DAY_CNT string").repartition(4)
    monkeypatch.setattr(ingest_checks, "raw_frame", lambda *_: raw.persist())
    drops = ingest_checks.mixed_drops(spark, "")
    assert max(len(spark.read.text(d).inputFiles()) for d in drops) > 1
