"""Queries on sources and sinks (SRC, SNK): each writes given tables and reads them back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from textgrove.operators import evaluate as E
from textgrove.operators import profile as P
from textgrove.operators.scale import new_path
from textgrove.queries.common import LABELLED, labelled, query, rounded, scored, scored_sql, table
from textgrove.queries.evaluate import M, auc_sql, metrics_sql, per_class_sql
from textgrove.queries.profile import WORDS
from textgrove.sources import catalogue as C
from textgrove.sources import readers as R
from textgrove.sources import sinks as S


@query("src_01_load_dataset", """
SELECT text, CAST(turn AS BIGINT) AS label, role AS split FROM conversations""")
def load_dataset(spark, sf_dir):
    root = new_path(spark, "datasets")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("text").alias("content"), F.col("turn").alias("label"), F.col("role").alias("split")
    )
    turns.write.partitionBy("split").parquet(f"{root}/amazon_polarity")
    return C.load_dataset(spark, root, "amazon_polarity").select("text", "label", "split")


@query("src_01_load_one_split", """
SELECT text, CAST(turn AS BIGINT) AS label FROM conversations WHERE role = 'user'""")
def load_one_split(spark, sf_dir):
    root = new_path(spark, "datasets")
    turns = table(spark, sf_dir, "conversations").select(
        "text", F.col("turn").alias("label"), F.col("role").alias("split")
    )
    turns.write.partitionBy("split").parquet(f"{root}/imdb")
    return C.load_dataset(spark, root, "imdb", "user").select("text", "label")


ROUND_TRIP = f"WITH {LABELLED} SELECT text, label FROM labelled"


def map_parts(lines):
    """Turn the records of each partition into one array, as data frame libraries write it."""

    def bracket(batches):
        mark = "["
        for batch in batches:
            for line in batch["value"]:
                yield pd.DataFrame({"value": [mark + line]})
                mark = ","
        yield pd.DataFrame({"value": ["[]" if mark == "[" else "]"]})

    return lines.mapInPandas(bracket, "value string")


def round_trip(spark, sf_dir, fmt, schema=None):
    """Labelled texts written in a format, with a column to drop, and read back."""
    rows, path = labelled(spark, sf_dir).select("id", "text", "label"), new_path(spark, fmt)
    if fmt in ("csv", "tsv"):
        rows.write.csv(path, sep="\t" if fmt == "tsv" else ",", header=True, quote='"', escape='"')
    elif fmt == "json":
        lines = rows.select(F.to_json(F.struct("*")).alias("value")).repartition(8, "value")
        map_parts(lines).write.text(path)
    else:
        rows.write.json(path)
    return R.read_labelled(spark, path, fmt=fmt, schema=schema)


@query("src_02_csv", ROUND_TRIP)
def csv(spark, sf_dir):
    return round_trip(spark, sf_dir, "csv")


@query("src_03_tsv", ROUND_TRIP)
def tsv(spark, sf_dir):
    return round_trip(spark, sf_dir, "tsv", "id long, text string, label int")


@query("src_04_json", ROUND_TRIP)
def json(spark, sf_dir):
    return round_trip(spark, sf_dir, "json", "id long, text string, label int")


@query("src_04_json_lines", ROUND_TRIP)
def json_lines(spark, sf_dir):
    return round_trip(spark, sf_dir, "jsonl", "id long, text string, label int")


@query("src_06_text_and_label", "SELECT text, lang AS label FROM documents")
def text_and_label(spark, sf_dir):
    path = f"{sf_dir}/documents.parquet"
    return R.read_labelled(spark, path, label="lang", fmt="parquet").withColumnRenamed("lang", "label")


@query("src_07_unify", "SELECT text, role AS label FROM conversations")
def unify(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        F.col("text").alias("content"), F.col("role").alias("label")
    )
    return C.unify(rows, C.dataset_spec("amazon_polarity"))


@query("snk_01_analysis", rf"""
WITH {LABELLED}
SELECT lang AS split, count(*) AS num_samples, count(DISTINCT label) AS num_labels,
       round(avg(length(text)), 6) AS avg_text_length, round(avg({WORDS}), 6) AS avg_word_count
FROM labelled GROUP BY lang""")
def analysis(spark, sf_dir):
    found, path = P.analyze(labelled(spark, sf_dir, heavy=True), by="lang"), new_path(spark, "analysis")
    found = found.withColumn("label_distribution", found["label_distribution"].cast("map<string,long>"))
    S.write_json(found, path)
    back = S.read_json(spark, path, found.schema)
    return rounded(back.select("split", "num_samples", "num_labels", "avg_text_length", "avg_word_count"))


@query("snk_02_results", f"WITH {scored_sql()}, {metrics_sql('scored')} SELECT {M}, n FROM metrics")
def results(spark, sf_dir):
    found, path = E.metrics(scored(spark, sf_dir)), new_path(spark, "results")
    S.write_json(found, path)
    return rounded(S.read_json(spark, path, found.schema))


@query("snk_03_report", f"""
WITH {scored_sql()}, {metrics_sql('scored')}, {per_class_sql('scored')}, {auc_sql('scored')},
c AS (SELECT string_agg(CAST(support AS VARCHAR), ',' ORDER BY class) AS supports,
             round(max(f1) FILTER (class = 0), 6) AS f1_0, round(max(f1) FILTER (class = 1), 6) AS f1_1 FROM per_class)
SELECT 'test' AS name, n AS size, {M}, round(roc_auc, 6) AS roc_auc, supports, f1_0, f1_1 FROM metrics, auc, c""")
def report(spark, sf_dir):
    found, path = E.report(scored(spark, sf_dir), "test"), new_path(spark, "report")
    S.write_json(found, path)
    back = S.read_json(spark, path, found.schema)
    classes = F.col("per_class_metrics")
    return rounded(
        back.select(
            "dataset_info.*",
            "metrics.*",
            F.array_join(F.transform(classes["support"], lambda x: x.cast("string")), ",").alias("supports"),
            classes["f1"][0].alias("f1_0"),
            classes["f1"][1].alias("f1_1"),
        )
    )


@query("snk_06_predictions", f"""
WITH {scored_sql()}
SELECT lang AS split, count(*) AS n, sum(y_pred)::BIGINT AS positives, round(sum(score), 6) AS scores
FROM scored GROUP BY lang""")
def predictions(spark, sf_dir):
    path = new_path(spark, "predictions")
    S.save_predictions(scored(spark, sf_dir).withColumnRenamed("lang", "split").drop("text"), path)
    return rounded(
        spark.read.parquet(path)
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.sum("y_pred").alias("positives"), F.sum("score").alias("scores"))
    )
