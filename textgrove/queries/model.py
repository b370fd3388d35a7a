"""Queries on models, batch functions and streams (MDL, UDF, EVL-23, SNK-4, SNK-5)."""

from __future__ import annotations

from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import functions as F

from textgrove.functions import vectors as V
from textgrove.operators import evaluate as E
from textgrove.operators import model as L
from textgrove.operators.mapping import map_batches
from textgrove.operators.scale import new_path, settle
from textgrove.operators.split import three_way_split
from textgrove.plans.workflow import train_and_evaluate
from textgrove.queries.common import LABELLED, documents, labelled, query, rounded, scored, scored_sql, table
from textgrove.queries.split import THREE_WAY
from textgrove.queries.text import clean_sql
from textgrove.sources import sinks as S
from textgrove.streaming import scoring

def parts(spark, sf_dir):
    """Labelled texts with a split, written once."""
    rows = three_way_split(labelled(spark, sf_dir), "id", "label")
    return settle(rows.repartition(spark.sparkContext.defaultParallelism, "id"), "parts")


def part(rows, name):
    return rows.filter(F.col("split") == name)


def flagship(spark, sf_dir):
    """Clean, split, train, score the test rows and evaluate them."""
    outcome = train_and_evaluate(labelled(spark, sf_dir, heavy=True))
    return E.evaluate_split(outcome.scored, "test")


def share(*columns):
    """Whether all of these are numbers from 0 to 1."""
    return F.coalesce(reduce(and_, [F.col(c).between(0, 1) for c in columns]), F.lit(False))


#: What a fitted model must keep to whatever it has learned; SQL cannot fit one.
MEASURES = ("accuracy", "precision", "recall", "f1")
TESTED = f"""
WITH {THREE_WAY}
SELECT 'test' AS dataset, count(*) AS num_samples, true AS in_range, true AS recall_is_accuracy, true AS better_than_chance
FROM three_way WHERE split = 'test'"""


@query("mdl_01_train", TESTED)
def train(spark, sf_dir):
    """The evaluation of a trained classifier: its rows, ranges, and that it beats guessing."""
    found = settle(flagship(spark, sf_dir), "evaluation")
    return found.select(
        "dataset",
        "num_samples",
        share(*MEASURES).alias("in_range"),
        (F.abs(F.col("recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"),
        (F.col("accuracy") > 0.5).alias("better_than_chance"),
    )


def consistent(positive=1):
    """Whether class, confidence and score of a row of two classes agree with its probabilities."""
    p = F.col("probabilities")
    return (
        (F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9)
        & (F.col("confidence") == F.array_max(p))
        & (F.col("y_pred") == F.array_position(p, F.array_max(p)) - 1)
        & (F.col("score") == p[positive])
    )


@query("mdl_02_predict", f"WITH {THREE_WAY} SELECT id, label, split, true AS consistent, true AS in_range FROM three_way")
def predict(spark, sf_dir):
    rows = parts(spark, sf_dir)
    model = L.train(part(rows, "train"))
    scored_rows = L.predict(model, rows)
    return scored_rows.select("id", "label", "split", consistent().alias("consistent"), share("confidence", "score").alias("in_range"))


LOGITS = """
l AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT vec_id, max(x) AS mx FROM l GROUP BY vec_id),
e AS (SELECT l.vec_id, l.i, l.x, exp(l.x - m.mx) AS e FROM l JOIN m ON l.vec_id = m.vec_id),
s AS (SELECT vec_id, sum(e) AS se, arg_max(i, (x, -i)) - 1 AS best, count(*) AS classes FROM e GROUP BY vec_id)"""


@query("mdl_03_softmax", f"""
WITH {LOGITS}
SELECT e.vec_id, max('LABEL_' || best) AS predicted_class, round(max(e) / max(se), 6) AS confidence,
       round(sum(e / se), 6) AS total, max(classes) AS classes
FROM e JOIN s ON e.vec_id = s.vec_id GROUP BY e.vec_id""")
def softmax(spark, sf_dir):
    p = F.col("p")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", V.softmax(F.col("embedding")).alias("p"))
    predicted = rows.select("vec_id", V.prediction(p, V.default_names(p)).alias("r"))
    total = F.aggregate("r.all_probabilities", F.lit(0.0), lambda a, x: a + x)
    return rounded(
        predicted.select(
            "vec_id",
            "r.predicted_class",
            "r.confidence",
            total.alias("total"),
            F.size("r.class_names").cast("long").alias("classes"),
        )
    )


@query("mdl_04_save_and_load", f"WITH {THREE_WAY} SELECT id, true AS same FROM three_way WHERE split = 'test'")
def save_and_load(spark, sf_dir):
    """A model that is loaded predicts what the saved one did."""
    rows, path = parts(spark, sf_dir), new_path(spark, "model")
    model = L.train(part(rows, "train"))
    L.save_model(model, path)
    before = L.predict(model, part(rows, "test")).select("id", F.struct("y_pred", "probabilities").alias("before"))
    after = L.predict(L.load_model(path), part(rows, "test")).select("id", F.struct("y_pred", "probabilities").alias("after"))
    return before.join(after, "id").select("id", (F.col("before") == F.col("after")).alias("same"))


@query("mdl_05_model_info", """
WITH c AS (SELECT count(DISTINCT quality) AS classes, 65536 + 1 AS parameters FROM labels)
SELECT 'model' AS model, classes AS num_labels, parameters AS num_parameters,
       round(parameters * 8 / 1048576.0, 6) AS model_size_mb FROM c""")
def model_info(spark, sf_dir):
    rows = parts(spark, sf_dir)
    return rounded(L.model_info(L.train(part(rows, "train")), rows))


def trials(spark, sf_dir):
    rows = parts(spark, sf_dir)
    return L.tune(part(rows, "train"), part(rows, "validation"))


@query("mdl_06_tune", """
SELECT unnest(range(0, 20))::INTEGER AS trial_number, true AS in_range, true AS in_space, true AS no_error""")
def tune(spark, sf_dir):
    found = settle(trials(spark, sf_dir), "trials").select("*", "params.*")
    space = F.col("regParam").between(*L.SEARCH["regParam"]) & F.col("numFeatures").isin(L.SEARCH["numFeatures"])
    return found.select(
        "trial_number",
        share("value").alias("in_range"),
        (space & F.col("maxIter").between(*L.SEARCH["maxIter"])).alias("in_space"),
        F.col("error").isNull().alias("no_error"),
    )


@query("snk_05_trial_results", """
SELECT 20::BIGINT AS n_trials, 20 AS listed, true AS best_of_all, true AS best_is_listed, true AS same_when_read""")
def trial_results(spark, sf_dir):
    """Results of a search, written and read again: the best of all trials with its parameters."""
    path, found = new_path(spark, "trials"), settle(S.trial_results(settle(trials(spark, sf_dir), "trials")), "results")
    S.write_json(found, path)
    read = S.read_json(spark, path, found.schema)
    best = F.filter("trials", lambda t: (t["value"] == F.col("best_value")) & (t["params"] == F.col("best_params")))
    return read.select(
        "n_trials",
        F.size("trials").alias("listed"),
        (F.col("best_value") == F.array_max(F.transform("trials", lambda t: t["value"]))).alias("best_of_all"),
        (F.size(best) > 0).alias("best_is_listed"),
        F.lit(read.exceptAll(found).isEmpty() and found.exceptAll(read).isEmpty()).alias("same_when_read"),
    )


@query("snk_04_final_results", f"""
WITH {THREE_WAY}
SELECT count(*) FILTER (split = 'train') AS trained, count(*) FILTER (split = 'test') AS tested, true AS in_range,
       count(DISTINCT label) AS num_labels, 65537 AS num_parameters, 0.2 AS validation, 0.1 AS test, 42 AS seed, true AS same_when_read
FROM three_way""")
def final_results(spark, sf_dir):
    """The results of a run, written and read again: rows, ranges, facts of the model, settings."""
    path = new_path(spark, "final")
    found = settle(train_and_evaluate(labelled(spark, sf_dir, heavy=True)).results, "results")
    S.write_json(found, path)
    read = S.read_json(spark, path, found.schema)
    return read.select(
        F.col("training.num_samples").alias("trained"),
        F.col("evaluation.num_samples").alias("tested"),
        share(*[f"{part}.{m}" for part in ("training", "evaluation") for m in MEASURES]).alias("in_range"),
        "model_info.num_labels",
        "model_info.num_parameters",
        "settings.*",
        F.lit(read.exceptAll(found).isEmpty()).alias("same_when_read"),
    )


# Trials as thresholds on the made-up scores; the last one has failed.
THRESHOLDS = [0.2, 0.35, 0.5, 0.65, None]


def threshold_trials(spark, sf_dir):
    options = F.array(*[
        F.struct(F.lit(i).alias("trial_number"), F.lit(t).cast("double").alias("threshold"))
        for i, t in enumerate(THRESHOLDS)
    ])
    rows = scored(spark, sf_dir).select("y_true", "score", F.inline(options))
    rows = rows.withColumn("y_pred", (F.col("score") >= F.coalesce("threshold", F.lit(0.0))).cast("int"))
    found = E.metrics(rows, ["trial_number"])
    failed = F.col("trial_number") == len(THRESHOLDS) - 1
    return found.select("trial_number", F.when(~failed, F.col("f1")).alias("value"))


@query("mdl_07_best_trial", f"""
WITH {scored_sql()},
o(trial_number, threshold) AS (VALUES (0, 0.2::DOUBLE), (1, 0.35::DOUBLE), (2, 0.5::DOUBLE), (3, 0.65::DOUBLE), (4, NULL)),
r AS (SELECT trial_number, y_true, CASE WHEN score >= threshold THEN 1 ELSE 0 END AS y_pred, threshold FROM scored, o),
k AS (SELECT trial_number, c.c, count(*) FILTER (y_true = c AND y_pred = c) AS tp, count(*) FILTER (y_true = c) AS t,
             count(*) FILTER (y_pred = c) AS p FROM r, (VALUES (0), (1)) c(c) WHERE threshold IS NOT NULL GROUP BY ALL),
f AS (SELECT trial_number, sum(CASE WHEN t + p > 0 THEN 2.0 * tp / (t + p) ELSE 0 END * t) / sum(t) AS value FROM k GROUP BY 1
      UNION ALL SELECT 4, 0.0)
SELECT trial_number, round(value, 6) AS value FROM f ORDER BY value DESC, trial_number LIMIT 1""")
def best_trial(spark, sf_dir):
    return rounded(L.best_trial(threshold_trials(spark, sf_dir)))


@query("mdl_08_compare", f"""
WITH {THREE_WAY}
SELECT m.model, count(*) AS n, true AS in_range, true AS recall_is_accuracy
FROM three_way, (VALUES ('logistic'), ('bayes'), ('svm')) m(model) WHERE split = 'test' GROUP BY m.model""")
def compare(spark, sf_dir):
    rows = parts(spark, sf_dir)
    found = E.compare_models(L.compare(part(rows, "train"), part(rows, "test")))
    return found.select("model", "n", share(*MEASURES).alias("in_range"), (F.abs(F.col("recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"))


@query("mdl_09_cross_lingual", f"""
WITH {LABELLED} SELECT lang, count(*) AS n, true AS in_range FROM labelled WHERE lang <> 'en' GROUP BY lang""")
def cross_lingual(spark, sf_dir):
    found = E.metrics(L.cross_lingual(parts(spark, sf_dir), ["en"]), ["lang"])
    return found.select("lang", "n", share(*MEASURES).alias("in_range"))


@query("mdl_10_stream_clean", f"SELECT doc_id, lang, {clean_sql('text')} AS text FROM documents")
def stream_clean(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    rows = scoring.watch(spark, sf_dir, schema, glob="documents.parquet")
    out = new_path(spark, "stream")
    cleaned = scoring.clean_stream(rows.select("doc_id", "lang", "text"))
    scoring.write_stream(cleaned, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.schema("doc_id long, lang string, text string").parquet(out)


@query("mdl_10_stream_scores", "SELECT doc_id, true AS in_range, true AS confident FROM documents")
def stream_scores(spark, sf_dir):
    model = L.train(part(parts(spark, sf_dir), "train"))
    schema = table(spark, sf_dir, "documents").schema
    rows = scoring.watch(spark, sf_dir, schema, glob="documents.parquet").select("doc_id", "text")
    scores = scoring.score_stream(rows, model).select("doc_id", "y_pred", "confidence", "score")
    out = new_path(spark, "stream")
    scoring.write_stream(scores, out, f"{out}-checkpoint").awaitTermination()
    found = spark.read.schema(scores.schema).parquet(out)
    likelier = F.when(F.col("y_pred") == 1, F.col("score")).otherwise(1 - F.col("score"))
    return found.select("doc_id", share("confidence", "score").alias("in_range"), (F.abs(likelier - F.col("confidence")) < 1e-9).alias("confident"))


LOG = """
log AS (SELECT event_type AS run, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS step, avg(value) AS eval_f1
        FROM events GROUP BY ALL)"""


@query("mdl_11_checkpoints", f"""
WITH {LOG},
n AS (SELECT *, row_number() OVER w AS no, max(eval_f1) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM log WINDOW w AS (PARTITION BY run ORDER BY step)),
b AS (SELECT *, max(CASE WHEN before IS NULL OR eval_f1 > before THEN no END) OVER (PARTITION BY run ORDER BY step) AS latest FROM n),
s AS (SELECT *, min(CASE WHEN no - latest >= 3 THEN step END) OVER (PARTITION BY run) AS stop_step FROM b),
k AS (SELECT * FROM s WHERE stop_step IS NULL OR step <= stop_step)
SELECT run, arg_max(step, (eval_f1, -step)) AS best_step, round(max(eval_f1), 6) AS best_value,
       coalesce(max(stop_step), -1) AS stop_step, count(*) AS evaluations FROM k GROUP BY run""")
def checkpoints(spark, sf_dir):
    step = F.unix_timestamp(F.date_trunc("day", "ts"))
    log = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("run"), step.alias("step"))
        .agg(F.avg("value").alias("eval_f1"))
    )
    found = L.best_checkpoints(log)
    return rounded(found.withColumn("stop_step", F.coalesce("stop_step", F.lit(-1))))


@query("udf_01_map_batches", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, upper(lang) AS lang FROM documents""")
def batches(spark, sf_dir):
    def measure(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"doc_id": batch["doc_id"], "chars": batch["text"].str.len(), "lang": batch["lang"].str.upper()}
        )

    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return map_batches(docs, measure, "doc_id long, chars long, lang string")


@query("evl_23_cluster_errors", f"""
WITH {scored_sql()}
SELECT id, true AS placed, true AS equal_texts_together FROM scored WHERE y_true <> y_pred""")
def cluster_errors(spark, sf_dir):
    """Every error is in one of the groups; errors of equal text are in the same."""
    found = settle(E.errors(scored(spark, sf_dir)).repartition(spark.sparkContext.defaultParallelism), "errors")
    clusters = settle(L.cluster_errors(found, 4), "clusters")
    same = clusters.groupBy("text").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    return clusters.join(same, "text").select(
        "id", F.col("cluster").between(0, 3).alias("placed"), (F.col("low") == F.col("high")).alias("equal_texts_together")
    )
