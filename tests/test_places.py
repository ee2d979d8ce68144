import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from areapulse.operators import dimension, requests as req, spatial, vectors
from areapulse.schemas import ADMIN_SIG, DIM_SPATIAL
from areapulse.sources.vectors import VectorIndex


def polygons(spark, *items):
    return spark.createDataFrame([(c, f"unit {c}", ring) for c, ring in items], "code string, name string, ring array<struct<x:double,y:double>>")


ARROW = [(0.0, 0.0), (4.0, 0.0), (1.0, 2.0), (4.0, 4.0), (0.0, 4.0)]


def test_points_in_a_non_convex_ring(spark, rows):
    points = spark.createDataFrame([("in", 0.5, 2.0), ("notch", 3.0, 2.0), ("arm", 3.0, 0.3), ("out", -1.0, 2.0), ("corner", 0.0, 0.0), ("edge", 2.0, 0.0), ("none", None, 1.0)], "k string, x double, y double")
    for cell_edges in (2, 3, 16):
        assert rows(spatial.points_in_polygons(points, polygons(spark, ("p", ARROW)), "k", "x", "y", cell_edges), "k") == [("arm",), ("in",)]


def within(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            odd ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return odd


def test_jagged_polygons_of_unequal_size_equal_brute_force(spark, rows):
    rng = random.Random(7)

    def star(cx, cy, size, corners):
        turns = sorted(rng.uniform(0, 2 * np.pi) for _ in range(corners))
        return [(float(cx + size * r * np.cos(t)), float(cy + size * r * np.sin(t))) for t in turns for r in [rng.uniform(0.3, 1)]]

    shapes = {"country": [star(0, 0, 50, 900), star(5, 5, 3, 40)]} | {f"u{i}": [star(rng.uniform(-40, 40), rng.uniform(-40, 40), 0.5, 9)] for i in range(30)}
    frame = spark.createDataFrame([(c, c, r) for c, r in shapes.items()], "code string, name string, rings array<array<struct<x:double,y:double>>>")
    points = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60)) for i in range(1500)] + [(2000 + i, x + rng.uniform(-0.4, 0.4), y + rng.uniform(-0.4, 0.4)) for i in range(300) for x, y in [rng.choice(shapes[f"u{i % 30}"][0])]]
    want = sorted((i, c) for i, x, y in points for c, r in shapes.items() if within(x, y, r))
    assert len({c for _, c in want}) > 25
    got = spatial.points_in_polygons(spark.createDataFrame(points, "k long, x double, y double"), frame, "k", "x", "y")
    assert sorted((r["k"], r["polygon_code"]) for r in got.collect()) == want
    cells = {r["polygon_code"]: (r["n"], r["most"]) for r in spatial.cover(frame).groupBy("polygon_code").agg(F.count("*").alias("n"), F.max(F.size("_edges")).alias("most")).collect()}
    assert max(n for c, (n, _) in cells.items() if c != "country") <= 4
    assert cells["country"][0] < 900 and cells["country"][1] <= spatial.CELL_EDGES


def places(spark, *rows):
    columns = ["spatial_key", "spatial_label", "code", "lat", "lon", "emd_code", "sig_name", "sido_name"]
    full = [tuple(dict(zip(columns, r)).get(n) for n in DIM_SPATIAL.names) for r in rows]
    return spark.createDataFrame(full, DIM_SPATIAL)


def test_units_overwrite_and_overlaps_take_the_lowest_code(spark, rows):
    square = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
    dim = places(spark, ("a", "A", "7", 2.0, 0.5), ("b", "B", "8", 50.0, 50.0))
    got = spatial.assign_units(dim, polygons(spark, ("2", square), ("1", ARROW)))
    assert rows(got, "spatial_key", "spatial_label", "spatial_type", "code", "emd_name") == [("a", "unit 1", "emd", "1", "unit 1"), ("b", "B", None, "8", None)]


def admin(spark):
    return spark.createDataFrame([("11680", "Gangnam", "11", "Seoul"), ("26110", "Jung", "26", "Busan"), ("11140", "Jung", "11", "Seoul")], ADMIN_SIG)


def test_districts_match_by_unit_then_code_then_name(spark, rows):
    dim = places(spark, ("a", "Jung", "26110xx", None, None, "11680yy"), ("b", "Jung", "26110xx"), ("c", "Jung"), ("d", "else"), ("e", "Gangnam", None, None, None, None, "kept"))
    got = dimension.fill_hierarchy(dim, admin(spark))
    assert rows(got, "spatial_key", "sig_name", "sido_name") == [("a", "Gangnam", "Seoul"), ("b", "Jung", "Busan"), ("c", "Jung", "Seoul"), ("d", None, None), ("e", "kept", "Seoul")]
    assert rows(dimension.full_labels(got), "spatial_label") == [("Busan Jung",), ("Seoul Gangnam",), ("Seoul Jung",), ("Seoul kept",), ("else",)]


def test_districts_from_boundaries(spark, rows):
    frame = spark.createDataFrame([("1168", "x"), ("11680", " Gangnam "), ("ab", "no"), (None, "no"), ("99123456", "long")], "A1 string, A2 string")
    assert rows(dimension.admin_from_boundaries(frame, "A1", "A2")) == [("01168", "x", "01", "01"), ("11680", "Gangnam", "11", "서울특별시"), ("99123456", "long", "99", "99")]


def test_backfill_prefers_admin_names(spark, rows):
    dim = places(spark, ("a", "A", None, 1.0, 1.0), ("b", "B", None, 1.0, 1.0), ("c", "C"), ("d", "D", None, 1.0, 1.0, None, "s", "p"))
    answers = spark.createDataFrame([("a", "11680", "x", "Y z"), ("b", "99999", "x", "Y z"), ("c", "11680", "x", "Y"), ("d", "11680", "x", "Y")], "spatial_key string, sig_cd string, sig_kor_nm string, full_nm string")
    assert rows(dimension.backfill(dim, answers, admin(spark)), "spatial_key", "sig_name", "sido_code", "sido_name") == [
        ("a", "Gangnam", "11", "Seoul"), ("b", "x", "99", "Y"), ("c", None, None, None), ("d", "s", None, "p")]
    assert rows(dimension.backfill_targets(dim, 1), "spatial_key") == [("a",)]


def brute_force(items, k, threshold):
    want = []
    for i, v, g in items:
        scored = [(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, w, h in items if h == g]
        best = sorted([(-s, j) for s, j in scored if s >= threshold])[:k]
        want += [(i, j) for _, j in best]
    return sorted(want)


def test_vector_look_up_equals_brute_force_however_it_is_split(spark):
    random.seed(4)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    # One group holds most of the vectors, and near copies make dense cells.
    items = [(i, centres[rng.integers(6)] + rng.normal(scale=0.4, size=12), "hot" if i % 5 else "cold") for i in range(150)]
    frame = spark.createDataFrame([(i, [float(x) for x in v], g) for i, v, g in items], "id long, vector array<double>, g string")
    want = brute_force(items, 3, 0.92)
    assert len(want) > 150
    for pivots, block_rows in ((1, 4096), (4, 60), (6, 24)):
        got = vectors.nearest_stored(frame, frame, ["g"], k=3, threshold=0.92, pivots=pivots, block_rows=block_rows)
        assert sorted((r["query_id"], r["match_id"]) for r in got.collect()) == want
    assert vectors.nearest_stored(frame, frame.limit(0), ["g"]).count() == 0


def indexed(spark, tmp_path, items, lists):
    index = VectorIndex(spark, str(tmp_path / "index"), {"g": "string"})
    rows = spark.createDataFrame([(i, f"h{i}", [float(x) for x in v], g) for i, v, g in items], "id long, request_hash string, vector array<float>, g string")
    index.build(rows, lists=lists)
    return index


def test_stored_index_is_exact_and_compares_few_of_clustered_vectors(spark, tmp_path):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 24))
    items = [(i, centres[i % 30] + rng.normal(scale=0.15, size=24), "hot" if i % 5 else "cold") for i in range(1500)]
    asked = [(10_000 + i, centres[i % 30] + rng.normal(scale=0.15, size=24), "hot" if i % 5 else "cold") for i in range(0, 200)]
    index = indexed(spark, tmp_path, items, 30)
    queries = spark.createDataFrame([(i, [float(x) for x in v], g) for i, v, g in asked], "id long, vector array<double>, g string")
    stored = [(i, np.array(v, np.float32).astype(float), g) for i, v, g in items]
    want = []
    for i, v, g in asked:
        scored = [(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, w, h in stored if h == g]
        want += [(i, j) for _, j in sorted([(-s, j) for s, j in scored if s >= 0.92])[:5]]
    got = index.lookup(queries).collect()
    assert len(want) > 200 and sorted((r["query_id"], r["match_id"]) for r in got) == sorted(want)
    assert max(r["compared"] for r in got) < 300
    bounds = [(r["id"], r["bound"]) for r in index.probes(queries).collect()]
    assert all(b <= np.arccos(0.92) + 1e-5 for _, b in bounds)
    assert sorted((r["query_id"], r["match_id"]) for r in index.lookup(queries, block_rows=7).collect()) == sorted(want)


def test_added_vectors_replace_those_of_their_hash(spark, rows, tmp_path):
    rng = np.random.default_rng(9)
    centres = np.eye(6)
    index = indexed(spark, tmp_path, [(i, centres[i % 6] + rng.normal(scale=0.01, size=6), "g") for i in range(60)], 6)
    before = index.tables.version().parts["vectors"]
    opened = index.tables.read("vectors", index.schema)
    fresh = spark.createDataFrame([(100, "h0", [0.0, 1.0, 0.0, 0.0, 0.0, 0.0], "g"), (101, "h0", [0.0, 0.99, 0.01, 0.0, 0.0, 0.0], "g"), (102, "new", [0.0, 1.0, 0.0, 0.0, 0.0, 0.0], "g")], "id long, request_hash string, vector array<float>, g string")
    assert index.add(fresh) == 2
    after = index.tables.version().parts["vectors"]
    assert sum(before[n] != after[n] for n in before) == 2
    assert opened.count() == 60 and index.tables.read("vectors", index.schema).count() == 61
    query = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], "g"), (2, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0], "g"), (3, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], "other")], "id long, vector array<double>, g string")
    found = {(r["query_id"], r["match_id"]) for r in index.lookup(query, k=99).collect()}
    assert (1, 0) not in found and {(2, 101), (2, 102)} <= found and not {x for x in found if x[0] == 3 or x[1] == 100}
    empty = VectorIndex(spark, str(tmp_path / "none"), {"g": "string"})
    with pytest.raises(ValueError):
        empty.build(fresh.limit(0))


def test_request_tags(spark):
    texts = ["강남구 20대 여성 2024-01부터 2024-03-15", "전년 대비 시도별 2023년", "2023년 5월 1168010100 구별 연령", "주말 축제", "전체 요약", "2024-13 서울특별시 강남구"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r for r in req.tag_requests(frame).collect()}
    assert (got[0]["spatial_label"], got[0]["sex"], got[0]["age_like"], str(got[0]["date_start"]), str(got[0]["date_end"])) == ("강남구", "female", "20_%", "2024-01-01", "2024-03-15")
    assert (got[1]["qtype"], got[1]["level"], got[1]["view"], str(got[1]["date_end"])) == ("yoy", "sido", "v_activity_monthly_trend_sido", "2023-12-31")
    assert (got[2]["spatial_key"], got[2]["level"], got[2]["qtype"], str(got[2]["date_start"])) == ("1168010100", "sig", "demographics", "2023-05-01")
    assert [got[i]["is_global"] for i in range(6)] == [False, False, False, False, True, False]
    assert got[5]["spatial_label"] == "서울특별시 강남구" and got[5]["date_start"] is None


def test_query_fields(spark):
    frame = spark.createDataFrame([("매출 합계 13월 주말",), ("foot max",), ("uplift",), ("?",)], "text string")
    got = [(r["target"], r["aggregation"], r["month"], r["weekdays"]) for r in req.query_fields(frame).collect()]
    assert got == [("economic.sales", "sum", 12, ["SAT", "SUN"]), ("population.foot_traffic", "max", None, None), ("metrics.uplift", "avg", None, None), ("population.foot_traffic", "avg", None, None)]
    first = req.query_fields(frame).first()["query_json"]
    assert first == '{"target":"economic.sales","aggregations":["sum"],"filters":{"time":{"month":12,"weekdays":["SAT","SUN"]}}}'


def test_fingerprint_is_the_hash_of_the_joined_parts(spark):
    import hashlib

    got = spark.range(1).select(req.fingerprint(F.lit("a"), F.lit(1), F.lit("b"))).first()[0]
    assert got == hashlib.sha256(b"a1b").hexdigest()


def test_only_staged_tables_are_released(spark, tmp_path, monkeypatch):
    from areapulse import session

    monkeypatch.setattr(session, "_staged", {})
    kept = session.new_folder(spark, "kept")
    spark.range(3).write.parquet(kept)
    staged = session.stage(spark, spark.range(4), "released")
    assert staged.count() == 4 and session.release(spark) == 1 and session.release(spark) == 0
    assert spark.read.parquet(kept).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(staged.inputFiles()[0]).count()


def test_many_polygons_are_covered_by_many_tasks_and_few_finely(spark, monkeypatch):
    monkeypatch.setattr(spatial, "POLYGONS_AT_ONCE", 10)
    squares = [(f"u{i}", [(float(i), 0.0), (i + 0.5, 0.0), (i + 0.5, 0.5), (float(i), 0.5)]) for i in range(40)]
    frame = polygons(spark, *squares).coalesce(1)
    assert len(spatial.cover(frame).inputFiles()) > 1
    fine = spatial._fine(spatial.cover(polygons(spark, ("p", ARROW))))
    # most of the inside needs no edges any more
    size = F.pow(F.lit(4.0), -F.col("_level"))
    assert 5 < fine.where(F.size("_edges") == 0).agg(F.sum(size)).first()[0] <= 10
    points = spark.createDataFrame([(i, i / 4 + 0.25, 0.25) for i in range(160)], "k long, x double, y double")
    got = spatial.points_in_polygons(points, frame, "k", "x", "y").collect()
    assert sorted((r["k"], r["polygon_code"]) for r in got) == [(4 * i, f"u{i}") for i in range(40)]


def test_a_task_compares_many_blocks_with_all_its_queries(spark):
    rng = np.random.default_rng(6)
    items = [(i, rng.normal(size=8), "one") for i in range(300)]
    frame = spark.createDataFrame([(i, [float(x) for x in v], g) for i, v, g in items], "id long, vector array<double>, g string")
    got = vectors.nearest_stored(frame, frame, ["g"], k=4, threshold=0.2, pivots=3, block_rows=2)
    assert sorted((r["query_id"], r["match_id"]) for r in got.collect()) == brute_force(items, 4, 0.2)
    calls = vectors._match(4, 0.2, block_rows=7)(None, *[pd.DataFrame({"id": [i for i, _, _ in items], "vector": [v for _, v, _ in items]})] * 2)
    assert sorted(zip(calls["query_id"], calls["match_id"])) == brute_force(items, 4, 0.2)
