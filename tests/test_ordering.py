import random
import statistics

from pyspark.sql import functions as F

from areapulse.functions.ordering import group_medians, in_ranges, leading, numbered, running, value_positions


def test_positions_count_the_rows_ahead(spark, rows):
    random.seed(2)
    data = [("hot" if i % 3 else "cold", float(random.randint(0, 300))) for i in range(3000)] + [("hot", None)] * 5
    frame = spark.createDataFrame(data, "g string, v double")
    got = rows(value_positions(frame, ["g"], "v", descending=True))
    want = []
    for group in ("cold", "hot"):
        values = [v for g, v in data if g == group and v is not None]
        want += [(group, v, values.count(v), len(values), sum(x > v for x in values)) for v in set(values)]
    assert got == sorted(want, key=repr)


def test_medians_are_exact(spark):
    random.seed(3)
    data = [(g, random.uniform(-5, 5) if g != "same" else 1.0) for g, n in (("odd", 501), ("even", 400), ("same", 300), ("one", 1)) for _ in range(n)]
    frame = spark.createDataFrame([*data, ("even", None), ("none", None)], "g string, v double")
    got = {r["g"]: r["median"] for r in group_medians(frame, ["g"], "v").collect()}
    assert got == {g: statistics.median(v for k, v in data if k == g) for g in ("odd", "even", "same", "one")}


def test_running_values_cross_ranges(spark, rows):
    random.seed(4)
    data = [("hot" if i % 4 else f"g{i % 7}", i * 37 % 5003, random.getrandbits(62)) for i in range(4000)]
    frame = spark.createDataFrame(data, "g string, at long, bits long").repartition(7)
    order = [F.col("at").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = in_ranges(frame, ["g"], order)
        assert ranged.where("g = 'hot'").select("_range").distinct().count() > 1
        got = rows(running(ranged, ["g"], order, {"total": ("sum", "at"), "mixed": ("bit_xor", "bits")}, {"whole": "total"}))
        places = rows(numbered(frame.drop("bits"), ["g"], [F.col("at").desc()]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, numbers = [], []
    for group in {g for g, *_ in data}:
        total = mixed = 0
        mine = sorted((at, bits) for g, at, bits in data if g == group)
        for at, bits in mine:
            total, mixed = total + at, mixed ^ bits
            want.append((group, at, bits, sum(a for a, _ in mine), total, mixed))
        numbers += [(group, at, n) for n, (at, _) in enumerate(reversed(mine))]
    assert got == sorted(want, key=repr)
    assert places == sorted(numbers, key=repr)


def test_equal_rows_are_numbered_through(spark):
    frame = spark.createDataFrame([("a", 1)] * 500 + [("a", 2)] * 3, "g string, at int")
    got = sorted((r["at"], r["position"]) for r in numbered(frame, ["g"], [F.col("at").asc()]).collect())
    assert got == [(1, n) for n in range(500)] + [(2, 500 + n) for n in range(3)]


def test_leading_rows_of_any_number(spark, rows):
    frame = spark.createDataFrame([(i % 7, i) for i in range(500)], "v int, k int").repartition(6)
    order = [F.col("v").desc(), F.col("k").asc()]
    for count in (0, 1, 250, 499, 900):
        want = rows(frame.orderBy(*order).limit(count))
        assert rows(leading(frame, order, count)) == rows(leading(frame, order, count, at_once=0)) == want
    plan = leading(frame, order, 250, at_once=0)._jdf.queryExecution().toString()
    assert "Limit" not in plan and "TakeOrdered" not in plan
