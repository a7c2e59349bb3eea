"""Property tests: tolerant readers vs. small pure-Python models of the rules."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadlake.functions import first_truthy, to_bool, to_float, truthy
from roadlake.functions.values import digits_id

TRUE_W = {"true", "t", "1", "yes", "y"}
FALSE_W = {"false", "f", "0", "no", "n"}


def model_bool(s):
    if s is None:
        return None
    w = s.strip().lower()
    return True if w in TRUE_W else False if w in FALSE_W else None


def model_float(v):
    if v is None or v in ("", "null") or isinstance(v, (list, dict)):
        return None
    try:
        return float(v)
    except ValueError:
        return None


def model_digits(v):
    if isinstance(v, bool):
        return -1
    s = str(v)
    return int(s) if s.isascii() and s.isdigit() and int(s) < 2 ** 31 else -1


words = st.sampled_from(sorted(TRUE_W | FALSE_W) + ["maybe", "", "Yes ", " N", "TRUE"])
json_vals = st.one_of(st.none(), st.booleans(), st.integers(-10 ** 6, 10 ** 6),
                      st.sampled_from(["", "0", "x", " 7 ", "1e3", "null", "12"]),
                      st.lists(st.integers(), max_size=2))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), words), min_size=1, max_size=20))
def test_bool_words(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "w string")
    got = [r[0] for r in df.select(to_bool(F.col("w"))).collect()]
    assert got == [model_bool(v) for v in vals]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(json_vals, json_vals), min_size=1, max_size=15))
def test_truthy_chain_and_float(spark, pairs):
    docs = [json.dumps({"a": a, "b": b}) for a, b in pairs]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    v = F.try_parse_json("value")
    a = F.try_variant_get(v, "$.a", "variant")
    b = F.try_variant_get(v, "$.b", "variant")
    rows = df.select(truthy(a).alias("ta"), to_float(first_truthy(a, b)).alias("f"),
                     digits_id(a).alias("d")).collect()
    for (x, y), r in zip(pairs, rows):
        assert r["ta"] == bool(x)
        want = model_float(x or y)
        assert (r["f"] is None and want is None) or r["f"] == want
        if x is not None and not isinstance(x, list):
            assert r["d"] == model_digits(x)


def test_clean_has_no_single_partition_exchange(spark):
    from roadlake.operators import clean
    lines = spark.createDataFrame([(json.dumps({"station_id": 1, "ts": 1}),)], "value string")
    for fn in (clean.clean_rwis, clean.clean_wzdx, clean.clean_incidents):
        plan = fn(lines)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Exchange" not in plan


def test_haversine_reference_distance(spark):
    from roadlake.functions import haversine_km, within_radius
    df = spark.createDataFrame([(38.90, -77.04)], "lat double, lon double")
    d = df.select(haversine_km(39.29, -76.61, F.col("lat"), F.col("lon"))).collect()[0][0]
    assert abs(d - 57.0756) < 1e-3
    keep = [df.select(within_radius(F.col("lat"), F.col("lon"), 39.29, -76.61, r)).collect()[0][0]
            for r in (57.0, 58.0, 0.0, -1.0)]
    assert keep == [False, True, True, True]
