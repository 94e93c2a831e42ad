"""Hot keys: block-wise scans and salted joins give what the plain form gives."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from zonewright.operators import skew


def _rows(spark, n=400):
    rnd = random.Random(3)
    rows = [(i, "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(30)}", rnd.randrange(120),
             rnd.choice([None, "a", "b", "c"])) for i in range(n)]
    return spark.createDataFrame(rows, "seq bigint, key string, at bigint, v string")


def test_running_last_in_blocks_equals_one_window(spark):
    df = _rows(spark)
    w = Window.partitionBy("key").orderBy("at", "seq").rowsBetween(Window.unboundedPreceding, 0)
    plain = {r["seq"]: r["x"] for r in df.select("seq", F.last("v", True).over(w).alias("x")).collect()}
    for blocks in (1, 7, 40, None):
        got = skew.running_last(df, ["key"], ["at", "seq"], {"x": F.col("v")}, blocks=blocks)
        assert {r["seq"]: r["x"] for r in got.collect()} == plain


def test_previous_row_in_blocks_equals_lag(spark):
    df = _rows(spark)
    w = Window.partitionBy("key").orderBy("at", "seq")
    plain = {r["seq"]: r["x"] for r in df.select("seq", F.lag("seq").over(w).alias("x")).collect()}
    got = skew.running_last(df, ["key"], ["at", "seq"], {"x": F.col("seq")}, include_current=False, blocks=30)
    assert {r["seq"]: r["x"] for r in got.collect()} == plain


def test_arrival_number_in_blocks(spark):
    df = _rows(spark)
    w = Window.partitionBy("key").orderBy("at", "seq")
    plain = {r["seq"]: r["x"] for r in df.select("seq", F.row_number().over(w).alias("x")).collect()}
    got = skew.arrival_number(df, ["key"], ["at", "seq"], "x", blocks=30)
    assert {r["seq"]: r["x"] for r in got.collect()} == plain


def test_null_order_values_come_first(spark):
    df = spark.createDataFrame([(i, "h", None if i % 7 == 0 else i, str(i)) for i in range(60)],
                               "seq bigint, key string, at bigint, v string")
    w = Window.partitionBy("key").orderBy(F.col("at").asc_nulls_first(), "seq").rowsBetween(Window.unboundedPreceding, 0)
    plain = {r["seq"]: r["x"] for r in df.select("seq", F.last("v", True).over(w).alias("x")).collect()}
    got = skew.running_last(df, ["key"], ["at", "seq"], {"x": F.col("v")}, blocks=12)
    assert {r["seq"]: r["x"] for r in got.collect()} == plain


def test_no_block_is_large_whatever_the_order_values(spark):
    # a far outlier, all order values equal, all NULL, a NULL key, a text order column
    n, blocks = 6000, 12
    for at in ("if(id = 0, -1000000000000, id)", "7", "cast(null as bigint)", "cast(id as string)"):
        for key in ("'hot'", "cast(null as string)", "if(id % 3 = 0, 'hot', cast(id as string))"):
            df = spark.range(n).selectExpr(f"{key} key", f"{at} at", "id seq")
            sizes = [r["count"] for r in skew.in_blocks(df, ["key"], ["at", "seq"], blocks).groupBy("_block").count().collect()]
            assert sum(sizes) == n and max(sizes) < 2 * n / blocks


def test_ties_nulls_and_text_order_equal_one_window(spark):
    base = spark.range(600)
    for at in ("if(id = 0, -1000000000000, id)", "7", "cast(null as bigint)", "cast(id as string)"):
        df = base.selectExpr("if(id % 4 = 0, null, 'h') key", f"{at} at", "id seq", "if(id % 5 = 0, cast(id as string), null) v")
        w = Window.partitionBy("key").orderBy(F.col("at").asc_nulls_first(), "seq").rowsBetween(Window.unboundedPreceding, 0)
        plain = {r["seq"]: (r["x"], r["n"]) for r in df.select("seq", F.last("v", True).over(w).alias("x"), F.count("*").over(w).alias("n")).collect()}
        got = skew.running_last(df, ["key"], ["at", "seq"], {"x": F.col("v")}, blocks=9)
        assert {r["seq"]: r["x"] for r in got.collect()} == {k: x for k, (x, _) in plain.items()}
        numbered = skew.arrival_number(df, ["key"], ["at", "seq"], "n", blocks=9)
        assert {r["seq"]: r["n"] for r in numbered.collect()} == {k: n for k, (_, n) in plain.items()}


def test_salted_join_keeps_every_row(spark):
    df = _rows(spark)
    dim = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, d int")
    for how in ("left", "inner"):
        plain = sorted(map(tuple, df.join(dim, "key", how).select("seq", "d").collect()))
        salted = sorted(map(tuple, skew.salted_join(df, dim, ["key"], F.col("seq"), how, 4).select("seq", "d").collect()))
        assert plain == salted


def test_sorted_lists_keep_repeats(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "w"), ("a", "x"), ("b", "z"), ("b", None)], "key string, v string")
    got = {r["key"]: r["v"] for r in skew.sorted_lists(df, ["key"], "v").collect()}
    assert got == {"a": ["w", "x", "x"], "b": ["z"]}


def test_salted_join_plans_with_the_size_of_the_repeated_side(spark):
    facts = spark.range(50).select((F.col("id") % 7).alias("k"), F.col("id").alias("n"))

    def plan(keys):
        dim = spark.range(keys).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = skew.salted_join(facts, dim, ["k"], F.col("n"))
        assert {(r["n"], r["v"]) for r in joined.collect()} == {(n, n % 7 * 2) for n in range(50)}
        return skew.salted_join(facts, dim, ["k"], F.col("n"))._jdf.queryExecution().sparkPlan().toString()

    # 200,000 rows are under the broadcast limit, 16 times as many are not
    assert "SortMergeJoin" in plan(200_000)
    assert "SortMergeJoin" not in plan(20)
