"""Splits: exact sizes, disjoint and complete, independent of the layout of the input."""

import pytest
from pyspark.sql import functions as F

from textgrove.operators import scale, split as S
from textgrove.operators.split import largest_remainder


def rows(spark, n=1000, partitions=4):
    """Three classes; the first holds more than half of the rows."""
    label = F.when(F.col("id") % 10 < 6, 0).when(F.col("id") % 10 < 9, 1).otherwise(2)
    return spark.range(n).withColumn("label", label).repartition(partitions)


def sizes(df, *keys):
    return {tuple(r)[:-1] if len(keys) > 1 else r[0]: r[-1] for r in df.groupBy(*keys).count().collect()}


def test_three_way_sizes(spark):
    got = sizes(S.three_way_split(rows(spark), "id", "label"), "split", "label")
    assert got == {
        ("test", 0): 60, ("test", 1): 30, ("test", 2): 10,
        ("validation", 0): 120, ("validation", 1): 60, ("validation", 2): 20,
        ("train", 0): 420, ("train", 1): 210, ("train", 2): 70,
    }


def test_layout_does_not_matter(spark):
    a = S.three_way_split(rows(spark, partitions=1), "id", "label")
    b = S.three_way_split(rows(spark, partitions=7), "id", "label")
    assert a.exceptAll(b).count() == 0 and a.count() == 1000


def test_seed_matters(spark):
    a = S.stratified_split(rows(spark), "id", "label", seed=1)
    b = S.stratified_split(rows(spark), "id", "label", seed=2)
    assert a.exceptAll(b).count() > 0


def test_golden_remainders(spark):
    df = spark.range(399).withColumn("label", (F.col("id") >= 58).cast("int"))
    got = sizes(S.stratified_split(df, "id", "label"), "split", "label")
    assert got[("test", 0)] == 6 and got[("test", 1)] == 34


def test_single_member_is_an_error(spark):
    with pytest.raises(ValueError):
        S.stratified_split(spark.range(10).withColumn("label", (F.col("id") == 0).cast("int")), "id", "label")


def test_other_splits_are_dropped_kept_or_an_error(spark):
    df = rows(spark, 100).withColumn("split", F.expr("array('train', 'test', 'validation', 'unsupervised', null)[id % 5]"))
    assert sizes(S.prepare_splits(df, "id", "label"), "split") == {"train": 20, "test": 20, "validation": 20}
    assert S.prepare_splits(df, "id", "label", others="keep").count() == 100
    with pytest.raises(ValueError):
        S.prepare_splits(df, "id", "label", others="error")


def test_null_labels_form_a_class(spark):
    df = rows(spark, 100).withColumn("label", F.when(F.col("label") > 0, F.col("label")))
    got = sizes(S.three_way_split(df, "id", "label"), "split")
    assert got == {"test": 10, "validation": 20, "train": 70}


def test_given_splits_are_kept(spark):
    given = rows(spark).withColumn("split", F.when(F.col("id") < 100, "test").otherwise("train"))
    got = S.prepare_splits(given, "id", "label")
    assert sizes(got, "split") == {"test": 100, "train": 720, "validation": 180}
    assert got.filter("split = 'test' and id >= 100").count() == 0
    again = S.prepare_splits(got, "id", "label")
    assert again.exceptAll(got).count() == 0


def test_only_train_is_split_afresh(spark):
    got = S.prepare_splits(rows(spark).withColumn("split", F.lit("train")), "id", "label")
    assert sizes(got, "split") == {"test": 100, "validation": 200, "train": 700}


def test_samples(spark):
    df = rows(spark)
    assert S.take_seeded(df, "id", 33).count() == 33
    assert S.take_seeded(df, "id", 5000).count() == 1000
    assert S.take_seeded(df, "id", None).count() == 1000
    given = df.withColumn("split", F.when(F.col("id") < 100, "test").otherwise("train"))
    assert sizes(S.sample_splits(given, "id", 600), "split") == {"test": 100, "train": 600}
    assert sizes(S.cap_splits(given, "id", {"train": 10}), "split") == {"test": 100, "train": 10}


def test_rank_is_a_permutation(spark):
    got = scale.seeded_rank(rows(spark), "id", by=["label"])
    per = got.groupBy("label").agg(F.min("rank"), F.max("rank"), F.count_distinct("rank"), F.count("*")).collect()
    assert all(r[1] == 1 and r[2] == r[3] == r[4] for r in per)


def test_running_totals(spark):
    df = spark.range(500).select(F.pmod(F.xxhash64("id"), F.lit(3)).alias("g"), "id", (F.col("id") % 7).alias("v"))
    got = scale.running_totals(df, ["id"], ["v"], ["g"]).collect()
    by_group = {}
    for r in sorted(got, key=lambda r: r["id"]):
        assert r["v_before"] == by_group.get(r["g"], 0)
        by_group[r["g"]] = r["v_before"] + r["v"]
    assert all(by_group[r["g"]] == r["v_total"] for r in got) and len(got) == 500


def test_release_leaves_no_intermediate_tables(spark, tmp_path, monkeypatch):
    from textgrove.operators import scale

    monkeypatch.setattr(scale, "shared_folder", lambda _: str(tmp_path))
    out = tmp_path / "result"
    S.three_way_split(rows(spark, 50), "id", "label").write.parquet(str(out))
    assert len(list(tmp_path.iterdir())) == 2
    scale.release(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["result"]


def test_many_classes_are_ranked_by_ranges(spark):
    """The same shares whether one task ranks the classes or ranges of them are ranked."""
    classes = spark.createDataFrame([(None if i == 5 else i, 3 + i * 7 % 11) for i in range(60)], "label int, size long")
    total = classes.agg(F.sum("size")).first()[0]
    for take in (0, 17, 100, total):
        a, b = ({(r["label"], r["size"]): r["k"] for r in largest_remainder(classes, "size", total, take, "label", "k", many).collect()} for many in (False, True))
        assert a == b and sum(a.values()) == take
