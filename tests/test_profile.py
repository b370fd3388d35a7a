"""Profiles: guards and properties beyond the comparison with SQL."""

from pyspark.sql import functions as F

from textgrove.operators import profile as P
from textgrove.operators import sketches


def test_histogram_of_one_value(spark):
    got = P.histogram(spark.createDataFrame([(3,)] * 4, "v int"), "v", 4).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["n"]) for r in got] == [
        (2.5, 2.75, 0), (2.75, 3.0, 0), (3.0, 3.25, 4), (3.25, 3.5, 0),
    ]


def test_histogram_sums_to_rows_without_nulls(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 97).alias("v"))
    assert P.histogram(df, "v", 13).agg(F.sum("n")).first()[0] == 900
    floats = df.select(F.col("v").cast("double").alias("v"))
    assert P.histogram(floats, "v", 13).agg(F.sum("n")).first()[0] == 900
    assert P.histogram(df.filter("v is null"), "v", 13).count() == 0


def test_describe_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    r = P.describe(df, "v").first()
    assert (r["count"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)


def test_quantiles_under_skew(spark):
    df = spark.range(900).select(F.when(F.col("id") < 600, 5).otherwise(F.col("id")).alias("v"))
    r = P.quantiles(df, "v", {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert tuple(r) == (5.0, 5.0, 899.0)


def test_analyze_counts_null_text_and_label(spark):
    df = spark.createDataFrame([("a b", 1), (None, 1), ("c", None)], "text string, label int")
    r = P.analyze(df, by=None).first()
    assert (r["split"], r["num_samples"], r["num_labels"]) == ("dataset", 3, 1)
    assert r["label_distribution"] == {1: 2}
    assert (r["avg_text_length"], r["max_word_count"], r["min_word_count"]) == (2.0, 2, 1)


def test_advice(spark):
    df = spark.range(30).select(F.lit("x" * 1200).alias("text"), (F.col("id") < 25).cast("int").alias("label"), F.lit("train").alias("split"))
    got = {r["rule"]: (r["finding"], r["value"]) for r in P.advice(P.analyze(df)).collect()}
    assert got["size"][0].startswith("small") and got["max_length"][1] == 512
    assert got["balance"] == ("imbalanced: weight or resample", 5.0) and got["classes"][0] == "binary: sigmoid"


def test_profiles_put_together(spark):
    """Parts of any number give what one part of all rows gives; empty parts and nulls do no harm."""
    rows = spark.range(20000).select((F.col("id") % 7).alias("part"), F.when(F.col("id") % 11 > 0, (F.col("id") * 7919) % 5003).alias("v"))
    whole = {r["value"]: r for r in sketches.merged_profile(sketches.profile_parts(rows, [], ["v"])).collect()}["v"]
    parts = sketches.profile_parts(rows, ["part"], ["v"])
    none = sketches.profile_parts(rows.filter("part = 0 and v is null"), ["part"], ["v"])
    merged = sketches.merged_profile(parts).first()
    exact = rows.agg(F.count("v"), F.avg("v"), F.stddev_samp("v"), F.count_distinct("v")).first()
    for found in (whole, merged):
        assert found["rows"] == 20000 and found["count"] == exact[0]
        assert abs(found["mean"] - exact[1]) < 1e-6 and abs(found["std"] - exact[2]) < 1e-6
        assert abs(found["distinct"] / exact[3] - 1) < 0.04
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            assert abs(rows.filter(F.col("v") <= found[q]).count() / exact[0] - p) < 0.015
    empty = sketches.merged_profile(none).first()
    assert empty["count"] == 0 and empty["distinct"] == 0 and empty["q50"] is None and empty["std"] is None
    assert sketches.merged_profile(parts, ["part"]).count() == 7
