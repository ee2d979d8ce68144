"""SQL building blocks: the shared tables and views as common table expressions."""

from __future__ import annotations

PLACE_KEY = "lpad(CAST(c_nationkey AS VARCHAR), 5, '0') || '_' || c_mktsegment"

GOLD = f"""
admin_sig AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS sig_code, n_name AS sig_name,
         lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS sido_code, r_name AS sido_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
admin_sido AS (
  SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS sido_code, r_name AS sido_name FROM region),
dim_spatial AS (
  SELECT {PLACE_KEY} AS spatial_key,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN n_name ELSE n_name || ' ' || c_mktsegment END AS spatial_label,
         CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'emd' END AS spatial_type,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'FURNITURE')
              THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') || '00000' END AS code,
         CASE WHEN c_mktsegment <> 'FURNITURE'
              THEN CAST(33 + c_nationkey * 0.25 + length(c_mktsegment) * 0.01 AS DOUBLE) END AS lat,
         CASE WHEN c_mktsegment <> 'FURNITURE'
              THEN CAST(126 + n_regionkey * 0.5 + length(c_mktsegment) * 0.01 AS DOUBLE) END AS lon,
         CAST(NULL AS VARCHAR) AS emd_code, CAST(NULL AS VARCHAR) AS emd_name,
         CAST(NULL AS VARCHAR) AS sig_code, CAST(NULL AS VARCHAR) AS sig_name,
         CAST(NULL AS VARCHAR) AS sido_code, CAST(NULL AS VARCHAR) AS sido_name
  FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) JOIN nation ON c_nationkey = n_nationkey),
placed_orders AS (
  SELECT *, {PLACE_KEY} AS spatial_key FROM orders JOIN customer ON o_custkey = c_custkey),
gold_demographics AS (
  SELECT spatial_key, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         'month' AS granularity, 'telco' AS source,
         CASE WHEN l_linestatus = 'F' THEN 'female' ELSE 'male' END AS sex,
         substr(o_orderpriority, 1, 1) || '0_' || substr(o_orderpriority, 1, 1) || '9' AS age_group,
         sum(l_quantity) AS value
  FROM lineitem JOIN placed_orders ON l_orderkey = o_orderkey GROUP BY ALL),
gold_activity AS (
  SELECT spatial_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, 'month' AS granularity,
         'sales' AS source, CAST(NULL AS DOUBLE) AS foot_traffic, sum(o_totalprice) AS sales,
         CAST(count(*) AS DOUBLE) AS sales_count
  FROM placed_orders GROUP BY 1, 2, 3, 4
  UNION ALL
  SELECT spatial_key, date, 'month', 'telco', sum(value), NULL, NULL FROM gold_demographics GROUP BY 1, 2)
"""


def change(now: str, before: str) -> str:
    return f"({now} - {before}) / nullif({before}, 0)"


MONTHLY_SUMS = """
monthly_sums AS (
  SELECT spatial_key, date, sum(foot_traffic) AS foot_traffic, sum(sales) AS sales, sum(sales_count) AS sales_count
  FROM gold_activity WHERE granularity = 'month' GROUP BY spatial_key, date)
"""

# The same month a year ago, by month number.
YEAR_AGO = MONTHLY_SUMS + """,
year_ago AS (
  SELECT spatial_key, date, foot_traffic, sales, count(*) OVER back AS months_back,
         max(foot_traffic) OVER back AS foot_traffic_prev_year, max(sales) OVER back AS sales_prev_year
  FROM monthly_sums
  WINDOW back AS (PARTITION BY spatial_key ORDER BY year(date) * 12 + month(date) RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING))
"""
YEAR_ON_YEAR = f"""
SELECT *, {change('foot_traffic', 'foot_traffic_prev_year')} AS foot_traffic_yoy, {change('sales', 'sales_prev_year')} AS sales_yoy
FROM year_ago
"""
GROUP_SHARES = """
SELECT spatial_key, date, source, sex, age_group, value, total_value, value / nullif(total_value, 0) AS share
FROM (SELECT *, sum(value) OVER (PARTITION BY spatial_key, date, source) AS total_value
      FROM gold_demographics WHERE granularity = 'month')
"""

# A key answers to its own row first, then to the first place that has it as label.
TREND_NORM = MONTHLY_SUMS + """,
spellings AS (
  SELECT spatial_key AS spelling, '1' AS priority, spatial_label, spatial_type FROM dim_spatial
  UNION ALL SELECT spatial_label, '2' || spatial_key, spatial_label, spatial_type FROM dim_spatial),
key_names AS (
  SELECT spelling, arg_min(spatial_label, priority) AS known_label, arg_min(spatial_type, priority) AS known_type
  FROM spellings GROUP BY spelling),
trend_norm AS (
  SELECT ifnull(known_label, spatial_key) AS spatial_label, known_type AS spatial_type, date,
         sum(foot_traffic) AS foot_traffic, sum(sales) AS sales, sum(sales_count) AS sales_count
  FROM monthly_sums LEFT JOIN key_names ON spelling = spatial_key GROUP BY 1, 2, 3)
"""


def trend_admin(level: str) -> str:
    """One name per key (the default)."""
    return f"""
place_{level} AS (
  SELECT d.spatial_key, coalesce(coded.{level}_name, named.name, d.spatial_label) AS name
  FROM dim_spatial d LEFT JOIN admin_sig coded ON coded.sig_code = d.code[1:5]
  LEFT JOIN (SELECT sig_name AS label, arg_min(a.{level}_name, sig_code) AS name FROM admin_sig a GROUP BY 1) named
    ON named.label = d.spatial_label),
trend_{level} AS (
  SELECT coalesce(name, spatial_key) AS spatial_label, '{level}' AS spatial_type, date,
         sum(foot_traffic) AS foot_traffic, sum(sales) AS sales, sum(sales_count) AS sales_count
  FROM gold_activity LEFT JOIN place_{level} USING (spatial_key) WHERE granularity = 'month' GROUP BY ALL)
"""


def trend_admin_repeated(level: str) -> str:
    """The roll-up in which all fact rows of a (key, date) meet each other."""
    return f"""
trend_{level} AS (
  SELECT coalesce(coded.{level}_name, named.{level}_name, d.spatial_label, spatial_key) AS spatial_label,
         '{level}' AS spatial_type, date, sum(a.foot_traffic) AS foot_traffic, sum(a.sales) AS sales,
         sum(a.sales_count) AS sales_count
  FROM gold_activity a JOIN gold_activity other USING (spatial_key, date)
  LEFT JOIN dim_spatial d USING (spatial_key)
  LEFT JOIN admin_sig coded ON coded.sig_code = d.code[1:5]
  LEFT JOIN admin_sig named ON named.sig_name = d.spatial_label
  WHERE a.granularity = 'month' AND other.granularity = 'month' GROUP BY ALL)
"""


LEADERS = """
label_groups AS (
  SELECT spatial_label, date, sex, age_group, sum(value) AS value
  FROM gold_demographics JOIN dim_spatial USING (spatial_key) WHERE granularity = 'month' GROUP BY ALL),
label_leaders AS (
  SELECT spatial_label, date, top.sex || '_' || top.age_group AS dominant_group,
         top.value / nullif(everyone, 0) AS dominant_share
  FROM (SELECT spatial_label, date, sum(value) AS everyone,
               first(struct_pack(sex := sex, age_group := age_group, value := value)
                     ORDER BY value DESC NULLS FIRST, sex, age_group) AS top
        FROM label_groups GROUP BY spatial_label, date))
"""


def candidate(level: str) -> str:
    """Earlier months are met by their number in the series, means are grouped, and a rank is the
    place of a value in the list of its date's values; a missing value comes after all of them."""
    leader = {
        "norm": ("dominant_group, dominant_share", "LEFT JOIN label_leaders USING (spatial_label, date)"),
    }.get(level, ("CAST(NULL AS VARCHAR) AS dominant_group, CAST(NULL AS DOUBLE) AS dominant_share", ""))
    short = {"foot_traffic": "ft", "sales": "sales"}
    own = ", ".join(f"avg({c}) AS {s}_avg, stddev_samp({c}) AS {s}_std" for c, s in short.items())
    dated = ", ".join(
        f"avg({c}) AS {s}_avg_date, coalesce(list({c} ORDER BY {c} DESC) FILTER (WHERE {c} IS NOT NULL), []) AS {s}_falling"
        for c, s in short.items()
    )
    columns = ", ".join(
        f"month.{c} AS {s}_prev, {change(f'now.{c}', f'month.{c}')} AS {s}_mom_pct, "
        f"year.{c} AS {s}_prev_year, {change(f'now.{c}', f'year.{c}')} AS {s}_yoy_pct, "
        f"{s}_avg, {s}_std, (now.{c} - {s}_avg) / nullif({s}_std, 0) AS {s}_zscore, {s}_avg_date, "
        f"CAST(CASE WHEN now.{c} IS NULL THEN len({s}_falling) + 1 ELSE list_position({s}_falling, now.{c}) END AS BIGINT) AS {s}_rank"
        for c, s in short.items()
    )
    return f"""
numbered_{level} AS (
  SELECT *, row_number() OVER (PARTITION BY spatial_label ORDER BY date, spatial_type NULLS FIRST) AS nth FROM trend_{level}),
label_{level} AS (SELECT spatial_label, {own} FROM trend_{level} GROUP BY spatial_label),
dated_{level} AS (SELECT date, {dated} FROM trend_{level} GROUP BY date),
candidate_{level} AS (
  SELECT now.spatial_label, now.date, now.foot_traffic, now.sales, {columns}, {leader[0]}
  FROM numbered_{level} now
  LEFT JOIN numbered_{level} month ON month.spatial_label = now.spatial_label AND month.nth + 1 = now.nth
  LEFT JOIN numbered_{level} year ON year.spatial_label = now.spatial_label AND year.nth + 12 = now.nth
  JOIN label_{level} ON label_{level}.spatial_label = now.spatial_label
  JOIN dated_{level} ON dated_{level}.date = now.date
  {leader[1].replace("USING (spatial_label, date)", "ON label_leaders.spatial_label = now.spatial_label AND label_leaders.date = now.date")})
"""


ALL_VIEWS = ",".join([
    GOLD, TREND_NORM, trend_admin("sig"), trend_admin("sido"), LEADERS,
    candidate("norm"), candidate("sig"), candidate("sido"),
    """
candidate_all AS (
  SELECT 'norm' AS level, * FROM candidate_norm
  UNION ALL BY NAME SELECT 'sig' AS level, * FROM candidate_sig
  UNION ALL BY NAME SELECT 'sido' AS level, * FROM candidate_sido),
advanced AS (
  SELECT level, spatial_label,
    CASE WHEN isnan(corr(sales, foot_traffic)) THEN NULL ELSE corr(sales, foot_traffic) END AS corr_sales_foot_traffic,
    CASE WHEN isnan(regr_slope(sales, foot_traffic)) THEN NULL ELSE regr_slope(sales, foot_traffic) END
      AS sales_impact_slope,
    avg(abs(sales_zscore)) AS sales_impact_score, avg(abs(ft_zscore)) AS foot_traffic_impact_score
  FROM candidate_all WHERE sales IS NOT NULL AND foot_traffic IS NOT NULL GROUP BY 1, 2)
""",
])


def round_double(column: str) -> str:
    """The rounding of ``registry.round_double``."""
    value = f"CAST({column} AS DOUBLE)"
    large = f"round({value} + CAST(0.00137 AS DOUBLE), 2)"
    small = f"round({value} + CAST(0.00000137 AS DOUBLE), 5)"
    return f"CASE WHEN abs({value}) >= 1000 THEN {large} ELSE {small} END + CAST(0 AS DOUBLE)"


def statement(body: str, keep: str, doubles: str = "", ctes: str = GOLD) -> str:
    """``SELECT`` the named columns of ``body``, doubles rounded as on the Spark side."""
    columns = keep.split() + [f"{round_double(c)} AS {c}" for c in doubles.split()]
    head = f"WITH {ctes}" if ctes else ""
    return f"{head} SELECT {', '.join(columns)} FROM ({body}) AS final_rows"
