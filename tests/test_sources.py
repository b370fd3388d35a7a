"""Files: formats, missing cells, errors, splits on disk, results."""

import json

import pytest
from pyspark.sql import functions as F

from textgrove.operators.scale import new_path
from textgrove.sources import catalogue as C
from textgrove.sources import readers as R
from textgrove.sources import sinks as S

ROWS = [("He said \"hi\", then\nleft", 1), ("tab\there", 0), ("NA", 1)]


def write(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'label,text,x\n1,"He said ""hi"", then\nleft",q\n0,tab\there,q\n1,NA,q\n')
    got = R.read_labelled(spark, path)
    assert got.columns == ["text", "label"]
    assert [tuple(r) for r in got.collect()] == ROWS[:2] + [(None, 1)]


def test_tsv(spark, tmp_path):
    path = write(tmp_path, "a.tsv", 'text\tlabel\n"two\nlines"\t1\nplain\t0\n')
    assert [tuple(r) for r in R.read_labelled(spark, path, fmt="tsv").collect()] == [("two\nlines", 1), ("plain", 0)]


def test_json_array_and_lines(spark, tmp_path):
    records = [{"text": t, "label": n, "other": 1} for t, n in ROWS]
    array = write(tmp_path, "a.json", json.dumps(records, indent=1))
    lines = write(tmp_path, "a.jsonl", "\n".join(json.dumps(r) for r in records))
    assert [tuple(r) for r in R.read_labelled(spark, array, fmt="json").collect()] == ROWS
    assert [tuple(r) for r in R.read_labelled(spark, lines, fmt="jsonl").collect()] == ROWS


def test_errors_come_before_any_job(spark, tmp_path):
    path = write(tmp_path, "a.csv", "text,label\nx,1\n")
    with pytest.raises(ValueError, match="unsupported format"):
        R.read_labelled(spark, path, fmt="xml")
    with pytest.raises(ValueError, match="missing column body"):
        R.read_labelled(spark, path, text="body")
    with pytest.raises(ValueError, match="unknown data set"):
        C.dataset_spec("nonsense")


def test_one_split_reads_one_folder(spark):
    root = new_path(spark, "datasets")
    df = spark.range(10).select(F.col("id").cast("string").alias("text"), F.lit(1).alias("label"), F.when(F.col("id") < 3, "test").otherwise("train").alias("split"))
    df.write.partitionBy("split").parquet(f"{root}/imdb")
    got = C.load_dataset(spark, root, "imdb", "test")
    assert got.count() == 3 and len(C.load_dataset(spark, root, "imdb").columns) == 3
    assert "PartitionFilters: [isnotnull(split" in got._jdf.queryExecution().toString()


def test_pruning_reaches_the_scan(spark, sf_dir):
    got = R.read_labelled(spark, f"{sf_dir}/documents.parquet", label="lang", fmt="parquet").filter("lang = 'en'")
    plan = got._jdf.queryExecution().toString()
    assert "ReadSchema: struct<text:string,lang:string>" in plan and "EqualTo(lang,en)" in plan


def test_results_survive(spark):
    df = spark.createDataFrame([(0.5, [1.0, 2.0], {"a": 1})], "x double, y array<double>, z map<string,int>")
    path = new_path(spark, "results")
    S.write_json(df, path)
    assert S.read_json(spark, path, df.schema).first() == df.first()


def test_trial_results(spark):
    rows = [(0, 0.5, (0.1, 8)), (1, None, (0.2, 16)), (2, 0.5, (0.3, 8))]
    trials = spark.createDataFrame(rows, "trial_number int, value double, params struct<rate:double,size:int>")
    r = S.trial_results(trials).first()
    assert (r["best_value"], r["best_params"]["rate"], r["n_trials"], len(r["trials"])) == (0.5, 0.1, 3, 3)


def test_catalogue(spark):
    got = {r["name"]: r for r in C.catalogue(spark).collect()}
    assert got["amazon_polarity"]["text_column"] == "content" and got["emotion"]["num_labels"] == 6


def test_copies_get_ids_of_their_own(spark):
    copies = spark.createDataFrame([("same", 1)] * 50, "text string, label int").repartition(5)
    numbered = R.with_id(copies)
    assert numbered.select("id").distinct().count() == 50
    assert numbered.exceptAll(numbered).count() == 0


@pytest.mark.parametrize(
    ("name", "content", "schema"),
    [
        ("a.csv", "text,label\nfine,1\nsurplus,2,3\n", None),
        ("b.csv", 'text,label\nfine,1\n"open,2\nlast,3\n', None),
        ("c.csv", "text,label\nfine,1\nword,two\n", "text string, label int"),
        ("d.jsonl", '{"text": "fine", "label": 1}\n{"text": "broken", \n', "text string, label int"),
    ],
)
def test_bad_rows_are_errors(spark, tmp_path, name, content, schema):
    path = tmp_path / name
    path.write_text(content)
    with pytest.raises(Exception, match="(?i)malformed"):
        R.read_file(spark, str(path), name.rsplit(".", 1)[1], schema).collect()


def test_ids_do_not_depend_on_the_layout(spark):
    rows = spark.createDataFrame([(f"t{i % 40}", i % 3) for i in range(120)] + [(None, 1), (None, None)], "text string, label int")
    one, other = (sorted(map(tuple, R.with_id(rows.repartition(n)).collect()), key=lambda r: r[2]) for n in (1, 5))
    assert one == other and [r[2] for r in one] == list(range(122))
