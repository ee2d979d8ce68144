"""Hierarchy, polygons, vectors and request texts."""

from pyspark.sql import functions as F

from areapulse.checks.registry import check
from areapulse.checks.sqltext import GOLD, statement
from areapulse.functions.text import PROVINCE_NAMES
from areapulse.operators import dimension as dim_ops, requests as req, spatial, vectors
from areapulse.session import new_folder
from areapulse.sources.staging import gold, table
from areapulse.sources.vectors import VectorIndex

BOUNDARIES = """SELECT CASE WHEN c_acctbal < -500 THEN 'x' || CAST(c_custkey AS STRING) WHEN c_acctbal > 9900 THEN NULL
  ELSE ' ' || CAST(c_custkey AS STRING) END AS A1, ' ' || c_name AS A2 FROM {customer}"""
PROVINCES = "provinces(code, name) AS (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in PROVINCE_NAMES.items()) + ")"
ADMIN = f"""{PROVINCES}, districts AS (SELECT CASE WHEN length(trim(A1)) < 5 THEN lpad(trim(A1), 5, '0') ELSE trim(A1) END AS sig_code,
  trim(A2) AS sig_name FROM ({BOUNDARIES.format(customer='customer')})), named AS (SELECT sig_code, sig_name, left(sig_code, 2) AS sido_code,
  coalesce(name, left(sig_code, 2)) AS sido_name FROM districts LEFT JOIN provinces ON code = left(sig_code, 2)
  WHERE regexp_full_match(sig_code, '\\d+'))"""


def built_admin(spark, sf):
    return dim_ops.admin_from_boundaries(spark.sql(BOUNDARIES, customer=table(spark, sf, "customer")), "A1", "A2")


check("g1_admin_districts", statement("SELECT * FROM named", "sig_code sig_name sido_code sido_name", "", ADMIN))(built_admin)
check("g1_admin_provinces", statement("SELECT DISTINCT sido_code, sido_name FROM named", "sido_code sido_name", "", ADMIN))(
    lambda spark, sf: dim_ops.provinces(built_admin(spark, sf)))
check("g1_admin_upsert", statement(
    "SELECT coalesce(n.sig_code, o.sig_code) AS sig_code, coalesce(n.sig_name, o.sig_name) AS sig_name FROM named n "
    "FULL JOIN admin_sig o ON o.sig_code = n.sig_code", "sig_code sig_name", "", GOLD + "," + ADMIN))(
    lambda spark, sf: dim_ops.replace_by_key(gold(spark, sf).admin_sig, built_admin(spark, sf), "sig_code").select("sig_code", "sig_name"))

MATCHED = """matched AS (SELECT d.spatial_key, coalesce(e.sig_code, c.sig_code, n.sig_code) AS sig_code,
    coalesce(e.sig_name, c.sig_name, n.sig_name) AS sig_name, coalesce(e.sido_code, c.sido_code, n.sido_code) AS sido_code,
    coalesce(e.sido_name, c.sido_name, n.sido_name) AS sido_name FROM dim_spatial d
  LEFT JOIN admin_sig e ON e.sig_code = left(d.emd_code, 5) LEFT JOIN admin_sig c ON c.sig_code = left(d.code, 5)
  LEFT JOIN admin_sig n ON n.sig_name = d.spatial_label)"""
HIERARCHY = "spatial_key sig_code sig_name sido_code sido_name"
check("j8_match_admin", statement("SELECT * FROM matched", HIERARCHY, "", GOLD + "," + MATCHED))(
    lambda spark, sf: dim_ops.match_admin(gold(spark, sf).dim, gold(spark, sf).admin_sig).select("spatial_key", "matched.*"))
check("g2_fill_hierarchy", statement("SELECT * FROM matched", HIERARCHY, "", GOLD + "," + MATCHED))(
    lambda spark, sf: dim_ops.fill_hierarchy(gold(spark, sf).dim, gold(spark, sf).admin_sig).select(*HIERARCHY.split()))
check("g3_full_labels", statement(
    "SELECT d.spatial_key, CASE WHEN m.sig_name IS NOT NULL THEN m.sido_name || ' ' || m.sig_name ELSE d.spatial_label END AS spatial_label "
    "FROM dim_spatial d JOIN matched m ON m.spatial_key = d.spatial_key", "spatial_key spatial_label", "", GOLD + "," + MATCHED))(
    lambda spark, sf: dim_ops.full_labels(dim_ops.fill_hierarchy(gold(spark, sf).dim, gold(spark, sf).admin_sig)).select(
        "spatial_key", "spatial_label"))

# Polygons ------------------------------------------------------------------------------------

CORNERS = [("0", "0"), ("1.5", "0"), ("0.75", "0.2"), ("1.5", "0.35"), ("0", "0.35")]


def arrow(spark, sf):
    """A non-convex ring per nation."""
    x0, y0 = F.col("n_regionkey") * 2.0, F.col("n_nationkey") * 0.4 + 0.013
    ring = F.array(*[F.struct((x0 + float(x)).alias("x"), (y0 + float(y)).alias("y")) for x, y in CORNERS])
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"), ring.alias("ring"))


def _sql_edges() -> str:
    x0, y0 = "n_regionkey * CAST(2 AS DOUBLE)", "(n_nationkey * CAST(0.4 AS DOUBLE) + CAST(0.013 AS DOUBLE))"
    parts = []
    for (ax, ay), (bx, by) in zip(CORNERS, CORNERS[1:] + CORNERS[:1]):
        point = [f"{o} + CAST({v} AS DOUBLE) AS {n}" for o, v, n in ((x0, ax, "x1"), (y0, ay, "y1"), (x0, bx, "x2"), (y0, by, "y2"))]
        parts.append(f"SELECT n_nationkey AS code, {', '.join(point)} FROM nation")
    return "edge AS (" + " UNION ALL ".join(parts) + ")"


check("j9_points_in_polygons", f"""WITH {_sql_edges()},
  point AS (SELECT l_orderkey, l_linenumber, l_extendedprice / 10000 AS x, l_quantity / 5 AS y FROM lineitem)
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line, CAST(code AS VARCHAR) AS polygon_code, count(*) AS n FROM
    (SELECT l_orderkey, l_linenumber, x, y, code,
       sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) AS crossings
     FROM point JOIN edge ON true GROUP BY ALL) WHERE crossings % 2 = 1 GROUP BY 1, 2""")(
    lambda spark, sf: spatial.points_in_polygons(
        table(spark, sf, "lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
            (F.col("l_extendedprice") / 10000).alias("x"), (F.col("l_quantity") / 5).alias("y")),
        arrow(spark, sf), "line", "x", "y").groupBy("line", "polygon_code").agg(F.count(F.lit(1)).alias("n")))


def boxes(spark, sf):
    x0, y0 = 126 + F.col("n_regionkey") * 0.5, 33 + F.col("n_nationkey") * 0.25
    corners = [(0.0, 0.0), (0.095, 0.0), (0.095, 0.095), (0.0, 0.095)]
    ring = F.array(*[F.struct((x0 + x).alias("x"), (y0 + y).alias("y")) for x, y in corners])
    return table(spark, sf, "nation").select(
        F.format_string("%010d", F.col("n_nationkey") + 500).alias("code"), F.concat(F.lit("unit "), "n_name").alias("name"), ring.alias("ring"))


# Outer box, a hole in it, and an island beside it.
PARTS = [[(0.0, 0.0), (4.0, 0.0), (4.0, 6.0), (0.0, 6.0)], [(1.0, 1.0), (3.0, 1.0), (3.0, 4.0), (1.0, 4.0)], [(5.0, 7.0), (9.0, 7.0), (9.0, 9.5), (5.0, 9.5)]]


def parted(spark, sf):
    move = F.col("r_regionkey") * 0.3
    rings = F.array(*[F.array(*[F.struct((move + x).alias("x"), (move + y).alias("y")) for x, y in ring]) for ring in PARTS])
    return table(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name"), rings.alias("rings"))


PARTED = """(x > m AND x < m + 4 AND y > m AND y < m + 6 AND NOT (x >= m + 1 AND x <= m + 3 AND y >= m + 1 AND y <= m + 4))
  OR (x > m + 5 AND x < m + 9 AND y > m + 7 AND y < m + 9.5)"""
check("j9_multipart", f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line, CAST(r_regionkey AS VARCHAR) AS polygon_code, count(*) AS n
  FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / 10000 + 0.00007 AS x, l_quantity / 5 + 0.00003 AS y FROM lineitem)
  JOIN (SELECT r_regionkey, r_regionkey * CAST(0.3 AS DOUBLE) AS m FROM region) ON {PARTED} GROUP BY 1, 2""")(
    lambda spark, sf: spatial.points_in_polygons(
        table(spark, sf, "lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
            (F.col("l_extendedprice") / 10000 + 0.00007).alias("x"), (F.col("l_quantity") / 5 + 0.00003).alias("y")),
        parted(spark, sf), "line", "x", "y").groupBy("line", "polygon_code").agg(F.count(F.lit(1)).alias("n")))

# One polygon the size of a country with a jagged northern border, and units of 0.02 degrees.
TEETH = 400


def mixed_sizes(spark, sf):
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x0, y0 = 126 + F.col("p_partkey") % 50 * 0.1, 33 + F.floor(F.col("p_partkey") / 50) % 50 * 0.1
    ring = F.array(*[point(x0 + dx, y0 + dy) for dx, dy in ((0.0, 0.0), (0.02, 0.0), (0.02, 0.02), (0.0, 0.02))])
    units = table(spark, sf, "part").select(F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("code"), F.lit("unit").alias("name"), ring.alias("ring"))
    border = F.transform(F.sequence(F.lit(TEETH), F.lit(0)), lambda i: point(126.3 + i * (3.8 / TEETH), 37.6 + i % 2 * 0.05))
    country = F.concat(F.array(point(F.lit(126.3), F.lit(33.2)), point(F.lit(130.1), F.lit(33.2))), border)
    return units.union(spark.range(1).select(F.lit("c").alias("code"), F.lit("country").alias("name"), country.alias("ring")))


CUSTOMER_POINT = "SELECT c_custkey, 126 + c_custkey % 1000 * 0.005 + 0.0011 AS x, 33 + c_custkey * 7 % 1000 * 0.005 + 0.0007 AS y FROM customer"
check("j9_mixed_sizes", f"""
  WITH point AS ({CUSTOMER_POINT}), unit AS (SELECT p_partkey, 126 + p_partkey % 50 * 0.1 AS x0, 33 + p_partkey // 50 % 50 * 0.1 AS y0 FROM part)
  SELECT c_custkey, 'u' || CAST(p_partkey AS VARCHAR) AS polygon_code FROM point JOIN unit ON x > x0 AND x < x0 + 0.02 AND y > y0 AND y < y0 + 0.02
  UNION ALL SELECT c_custkey, 'c' FROM (SELECT *, (x - 126.3) / (3.8 / {TEETH}) AS t FROM point)
    WHERE x > 126.3 AND x < 130.1 AND y > 33.2 AND y < 37.6 + 0.05 * CASE WHEN floor(t) % 2 = 0 THEN t - floor(t) ELSE 1 - (t - floor(t)) END""")(
    lambda spark, sf: spatial.points_in_polygons(
        table(spark, sf, "customer").select("c_custkey", (126 + F.col("c_custkey") % 1000 * 0.005 + 0.0011).alias("x"), (33 + F.col("c_custkey") * 7 % 1000 * 0.005 + 0.0007).alias("y")),
        mixed_sizes(spark, sf), "c_custkey", "x", "y").select("c_custkey", "polygon_code"))

check("g4_multipart", statement(
    f"""SELECT spatial_key, coalesce(code2, code) AS code, CASE WHEN code2 IS NULL THEN spatial_type ELSE 'emd' END AS spatial_type FROM
      (SELECT d.*, (SELECT min(CAST(r_regionkey AS VARCHAR)) FROM (SELECT r_regionkey, r_regionkey * CAST(0.3 AS DOUBLE) AS m FROM region)
         WHERE {PARTED.replace('x ', '(d.lon - 126.003) ').replace('y ', '(d.lat - 33.003) ')}) AS code2 FROM dim_spatial d)""",
    "spatial_key code spatial_type"))(
    lambda spark, sf: spatial.assign_units(
        gold(spark, sf).dim.withColumns({"lon": F.col("lon") - 126.003, "lat": F.col("lat") - 33.003}), parted(spark, sf),
    ).select("spatial_key", "code", "spatial_type"))

check("g4_assign_units", statement(
    """SELECT spatial_key, CASE WHEN hit THEN 'unit ' || n_name ELSE spatial_label END AS spatial_label,
      CASE WHEN hit THEN 'emd' ELSE spatial_type END AS spatial_type,
      CASE WHEN hit THEN lpad(CAST(n_nationkey + 500 AS VARCHAR), 10, '0') ELSE code END AS code,
      CASE WHEN hit THEN 'unit ' || n_name END AS emd_name
    FROM (SELECT d.*, n.n_name, n.n_nationkey, d.lat IS NOT NULL AND d.lat < 33 + n_nationkey * 0.25 + 0.095 AS hit
          FROM dim_spatial d JOIN nation n ON n_nationkey = CAST(left(spatial_key, 5) AS INTEGER))""",
    "spatial_key spatial_label spatial_type code emd_name"))(
    lambda spark, sf: spatial.assign_units(gold(spark, sf).dim, boxes(spark, sf)).select(
        "spatial_key", "spatial_label", "spatial_type", "code", "emd_name"))

check("g5_backfill", statement(
    """SELECT d.spatial_key, CASE WHEN t THEN g.sig_cd END AS sig_code, CASE WHEN t THEN coalesce(s.sig_name, g.sig_kor_nm) END AS sig_name,
      CASE WHEN t THEN left(g.sig_cd, 2) END AS sido_code, CASE WHEN t THEN coalesce(s.sido_name, 'PROV') END AS sido_name
    FROM (SELECT *, lat IS NOT NULL AS t FROM dim_spatial) d
    LEFT JOIN (SELECT spatial_key, coalesce(left(code, 5), '99' || left(spatial_key, 3)) AS sig_cd, 'K ' || spatial_label AS sig_kor_nm
               FROM dim_spatial) g ON g.spatial_key = d.spatial_key
    LEFT JOIN admin_sig s ON s.sig_code = g.sig_cd""", HIERARCHY))(lambda spark, sf: dim_ops.backfill(
        gold(spark, sf).dim,
        gold(spark, sf).dim.select(
            "spatial_key", F.coalesce(F.substring("code", 1, 5), F.concat(F.lit("99"), F.substring("spatial_key", 1, 3))).alias("sig_cd"),
            F.concat(F.lit("K "), "spatial_label").alias("sig_kor_nm"), F.lit("PROV x").alias("full_nm")),
        gold(spark, sf).admin_sig).select(*HIERARCHY.split()))

# Vectors -------------------------------------------------------------------------------------

for _name, _threshold in (("k7_vector_lookup", 0.92), ("k7_vector_lookup_wide", 0.25)):
    check(_name, statement(f"""
      SELECT query_id, match_id, similarity, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, match_id) AS INTEGER) AS place
        FROM (SELECT q.vec_id AS query_id, c.vec_id AS match_id,
                list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS similarity
              FROM embeddings q JOIN embeddings c ON c.label = q.label) WHERE similarity >= {_threshold}) WHERE place <= 5""",
        "query_id match_id place", "similarity", ""))(
        lambda spark, sf, threshold=_threshold: vectors.nearest_stored(
            vectors_of(spark, sf), vectors_of(spark, sf), ["label"], threshold=threshold))


def vectors_of(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


# Requests that are like a stored one but not the same: a stored vector with some of the next one.
ASKED = "SELECT a.vec_id + 1000000 AS id, a.label, {vector} AS vector FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 3 = 0"


def stored_index(spark, sf):
    """Built from the even ids, to which the odd ones, and new vectors for some hashes, are added."""
    rows = vectors_of(spark, sf).withColumn("request_hash", F.sha2(F.col("id").cast("string"), 256))
    index = VectorIndex(spark, new_folder(spark, "index"), {"label": "int"})
    stale = rows.where("id % 10 = 0").withColumn("vector", F.reverse("vector")).withColumn("id", F.col("id") - 5_000_000)
    index.build(rows.where("id % 2 = 0 and id % 10 > 0").union(stale.select(*rows.columns)), lists=20)
    index.add(rows.where("id % 2 = 1 or id % 10 = 0"))
    return index


check("k7_indexed", statement(f"""
  SELECT query_id, match_id, similarity, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, match_id) AS INTEGER) AS place
    FROM (SELECT q.id AS query_id, c.vec_id AS match_id, list_cosine_similarity(q.vector, CAST(c.embedding AS DOUBLE[])) AS similarity
          FROM ({ASKED.format(embeddings='embeddings', vector='list_transform(range(1, 65), lambda i: CAST(CAST(a.embedding[i] AS DOUBLE) + 0.35 * CAST(b.embedding[i] AS DOUBLE) AS DOUBLE))')}) q
          JOIN embeddings c ON c.label = q.label) WHERE similarity >= 0.92) WHERE place <= 5""",
    "query_id match_id place", "similarity", ""))(lambda spark, sf: stored_index(spark, sf).lookup(
        spark.sql(ASKED.format(embeddings="{embeddings}", vector="zip_with(a.embedding, b.embedding, (x, y) -> CAST(x AS DOUBLE) + 0.35D * CAST(y AS DOUBLE))"),
                  embeddings=table(spark, sf, "embeddings"))).select("query_id", "match_id", "similarity", "place"))


# Requests ------------------------------------------------------------------------------------

REQUESTS = """SELECT conv_id, turn, CASE turn WHEN 0 THEN '경기도 성남시 2024-01 부터 2024-03-15 추이 ' WHEN 1 THEN '강남구 20대 여성 비중 2023년 5월 '
    WHEN 2 THEN '시도별 전년 대비 매출 합계 2022년 ' WHEN 3 THEN '4113510300 구별 최대 유동 인구 2023년 11월 2024년 2월 '
    WHEN 4 THEN '주말 sales 13월 ' WHEN 5 THEN '전체 요약 ' WHEN 6 THEN '남자 평일 uplift 최소 7월 ' ELSE '' END || text AS text FROM {conversations}"""


def requests_of(spark, sf):
    return spark.sql(REQUESTS, conversations=table(spark, sf, "conversations"))


_REQ = REQUESTS.format(conversations="conversations")
_DAY = "CAST(try_strptime(CASE WHEN length({0}) = 7 THEN {0} || '-01' ELSE {0} END, '%Y-%m-%d') AS DATE)"
TAGS = f"""SELECT *, CASE WHEN level = 'sido' THEN 'v_activity_monthly_trend_sido' WHEN level = 'sig' THEN 'v_activity_monthly_trend_sig'
    ELSE 'v_activity_monthly_trend_norm' END AS view,
    spatial_label IS NULL AND spatial_key IS NULL AND date_start IS NULL AND date_end IS NULL AND sex IS NULL AND age_like IS NULL
      AND NOT has_filter_words AS is_global
  FROM (SELECT conv_id, turn,
    CASE WHEN len(iso) = 0 AND len(ky) = 0 THEN CAST(nullif(yr, '') || '-01-01' AS DATE)
         WHEN len(iso) > 0 THEN {_DAY.format('iso[1]')} ELSE {_DAY.format("(ky[1] || '-' || lpad(km[1], 2, '0'))")} END AS date_start,
    CASE WHEN len(iso) = 0 AND len(ky) = 0 THEN CAST(nullif(yr, '') || '-12-31' AS DATE)
         WHEN len(iso) > 0 THEN {_DAY.format('coalesce(iso[2], iso[1])')}
         ELSE {_DAY.format("(coalesce(ky[2], ky[1]) || '-' || lpad(coalesce(km[2], km[1]), 2, '0'))")} END AS date_end,
    nullif(regexp_extract(text, '\\b\\d{{10,}}\\b'), '') AS spatial_key,
    CASE WHEN regexp_matches(text, '{req.PROVINCE_AND_PLACE}') THEN regexp_extract(text, '{req.PROVINCE_AND_PLACE}', 1) || ' ' ||
      regexp_extract(text, '{req.PROVINCE_AND_PLACE}', 2) ELSE nullif(regexp_extract(text, '{req.PLACE}', 1), '') END AS spatial_label,
    CASE WHEN regexp_matches(text, '여성|여자') THEN 'female' WHEN regexp_matches(text, '남성|남자') THEN 'male' END AS sex,
    nullif(regexp_extract(text, '{req.DECADE}', 1), '') || '_%' AS age_like,
    CASE WHEN regexp_matches(text, '도별|시도') THEN 'sido' WHEN regexp_matches(text, '시별|군별|구별|시군구') THEN 'sig' ELSE 'emd' END AS level,
    CASE WHEN regexp_matches(text, '전년|yoy') THEN 'yoy' WHEN regexp_matches(text, '비중|demographic|연령|성별') THEN 'demographics' ELSE 'trend' END AS qtype,
    regexp_matches(text, '주말|평일|날씨|이벤트|축제|공휴일') AS has_filter_words
  FROM (SELECT *, regexp_extract_all(text, '{req.ISO_DATE}') AS iso, regexp_extract_all(text, '{req.KOREAN_MONTH}', 1) AS ky,
      regexp_extract_all(text, '{req.KOREAN_MONTH}', 2) AS km, regexp_extract(text, '{req.KOREAN_YEAR}', 1) AS yr FROM ({_REQ})))"""
check("r11_request_tags", TAGS)(lambda spark, sf: req.tag_requests(requests_of(spark, sf)).drop("text"))

check("r11_request_tags_with_prior", f"""SELECT t.conv_id, t.turn, coalesce(p.lv, t.level) AS level,
    CASE WHEN p.lv IS NOT NULL THEN DATE '2020-01-01' ELSE t.date_start END AS date_start,
    CASE WHEN p.lv IS NOT NULL THEN NULL ELSE t.date_end END AS date_end FROM ({TAGS}) t
  LEFT JOIN (SELECT conv_id, 'sig' AS lv FROM conversations WHERE role = 'system' GROUP BY 1) p ON p.conv_id = t.conv_id""")(
    lambda spark, sf: req.tag_requests(requests_of(spark, sf), prior=table(spark, sf, "conversations").where("role = 'system'").select(
        "conv_id").distinct().withColumns({"level": F.lit("sig"), "date_start": F.lit("2020-01")}), key="conv_id").select(
        "conv_id", "turn", "level", "date_start", "date_end"))

check("r12_query_fields", f"""SELECT conv_id, turn,
    CASE WHEN regexp_matches(text, '경제|매출') OR contains(lower(text), 'sales') THEN 'economic.sales'
         WHEN regexp_matches(text, '인구|유동') OR contains(lower(text), 'foot') THEN 'population.foot_traffic'
         WHEN contains(lower(text), 'uplift') THEN 'metrics.uplift' ELSE 'population.foot_traffic' END AS target,
    CASE WHEN regexp_matches(text, '총|합계') OR contains(lower(text), 'sum') THEN 'sum' WHEN contains(text, '최대') OR contains(lower(text), 'max') THEN 'max'
         WHEN contains(text, '최소') OR contains(lower(text), 'min') THEN 'min' ELSE 'avg' END AS aggregation,
    least(greatest(CAST(nullif(regexp_extract(text, '(\\d{{1,2}})월', 1), '') AS INTEGER), 1), 12) AS month,
    CASE WHEN contains(text, '주말') THEN 'SAT,SUN' WHEN contains(text, '평일') THEN 'MON,TUE,WED,THU,FRI' END AS weekdays,
    sha256(CAST(conv_id AS VARCHAR) || CAST(turn AS VARCHAR) || text) AS fingerprint FROM ({_REQ})""".replace(
        "least(greatest(CAST", "CASE WHEN regexp_matches(text, '\\d{1,2}월') THEN least(greatest(CAST").replace("1), 12) AS month", "1), 12) END AS month"))(
    lambda spark, sf: req.query_fields(requests_of(spark, sf)).select(
        "conv_id", "turn", "target", "aggregation", "month", F.array_join("weekdays", ",").alias("weekdays"),
        req.fingerprint(F.col("conv_id"), F.col("turn"), F.col("text")).alias("fingerprint")))
