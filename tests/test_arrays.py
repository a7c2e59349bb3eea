"""Running values over arrays against plain loops."""

from itertools import accumulate

from pyspark.sql import functions as F

from roadlake.functions.arrays import let, running_max, running_sum


def test_running_values(spark):
    arrays = [[], [5], [3, -4], [1] * 1000, [((7 * i) % 13) - 6 for i in range(257)], None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id int, a array<bigint>")
    for r in df.select("id", "a", running_sum(F.col("a")).alias("s"), running_max(F.col("a")).alias("m")).collect():
        if r.a is None:
            assert r.s is None and r.m is None
        else:
            assert r.s == list(accumulate(r.a)) and r.m == list(accumulate(r.a, max))


def test_running_sum_of_a_long_array(spark):
    n = 300_000
    got = spark.range(1).select(let(running_sum(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("long"))),
                                    lambda s: F.struct(F.size(s).alias("n"), F.element_at(s, -1).alias("last"))).alias("r")).first().r
    assert (got.n, got.last) == (n, n * (n + 1) // 2)
