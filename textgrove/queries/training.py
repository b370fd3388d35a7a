"""Queries on training in rounds, search, outside models, term weights and bootstrap (MDL-2, MDL-6, MDL-11, EVL-22, EVL-24)."""

from __future__ import annotations

import json
import math
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textgrove.operators import bootstrap, external, halving, rounds, terms
from textgrove.operators import evaluate as E
from textgrove.operators import model as L
from textgrove.operators.scale import new_path, settle
from textgrove.queries.common import LABELLED, labelled, query, rounded, scored, scored_sql, table
from textgrove.queries.model import part, parts

TOP = 10


@query("evl_24_term_weights", f"""
WITH {LABELLED},
w AS (SELECT label, unnest(regexp_extract_all(lower(text), '\\S+')) AS term FROM labelled),
c AS (SELECT label, term, count(*) AS n FROM w GROUP BY ALL),
s AS (SELECT *, sum(n) OVER (PARTITION BY term) AS a, sum(n) OVER (PARTITION BY label) AS size, sum(n) OVER () AS tokens FROM c),
v AS (SELECT count(DISTINCT term) * 0.5 AS extra FROM c),
z AS (SELECT label AS class, term, n, ln((n + 0.5) / (size + extra)) - ln((a - n + 0.5) / (tokens - size + extra)) AS weight,
             sqrt(1 / (n + 0.5) + 1 / (a - n + 0.5)) AS error FROM s, v),
r AS (SELECT *, weight / error AS z, row_number() OVER (PARTITION BY class ORDER BY round(weight / error, 9) DESC, term) AS rank FROM z)
SELECT class, rank, term, n, round(weight, 6) AS weight, round(z, 6) AS z FROM r WHERE rank <= {TOP}""")
def term_weights(spark, sf_dir):
    return rounded(terms.term_weights(labelled(spark, sf_dir), TOP))


@query("evl_24_model_terms", f"""
SELECT c.class, r.rank, true AS descends, true AS known
FROM (VALUES (0), (1)) c(class), (SELECT unnest(range(1, {TOP + 1})) AS rank) r""")
def model_terms(spark, sf_dir):
    """Terms of a fitted model: that all ranks are there, by falling weight, with terms of the texts."""
    rows = labelled(spark, sf_dir)
    found = settle(terms.model_terms(L.train(rows, features=1 << 14, max_iter=5), rows, TOP), "found")
    counts = terms.term_counts(rows).withColumnRenamed("n", "counted")
    before = found.select("class", (F.col("rank") + 1).alias("rank"), F.col("weight").alias("before"))
    checked = found.join(counts, "term", "left").join(before, ["class", "rank"], "left")
    return checked.select(
        "class", "rank", (F.coalesce("before", "weight") >= F.col("weight")).alias("descends"), (F.col("counted") == F.col("n")).alias("known")
    )


ROUNDS, RATE, REG = 12, 4.0, 0.01


def two_features(spark, sf_dir):
    """Labelled documents with two numbers, one of five of them for validation."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.select(
        F.col("doc_id").alias("id"),
        (F.log(1.0 + F.col("n_chars")) / 10).alias("x1"),
        (F.col("lang") == "en").cast("double").alias("x2"),
        F.col("quality").alias("label"),
        (F.col("doc_id") % 5 == 0).alias("check"),
    )


def rounds_sql() -> str:
    """The same descent, one pair of subqueries for each round."""
    steps = ["w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c, NULL::DOUBLE AS loss)"]
    for k in range(1, ROUNDS + 1):
        steps.append(f"""g{k} AS MATERIALIZED (
  SELECT avg((p - y) * x1) AS a, avg((p - y) * x2) AS b, avg(p - y) AS c, avg(-ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) AS loss
  FROM (SELECT t.*, 1 / (1 + exp(-2 * (w.a * x1 + w.b * x2 + w.c))) AS p FROM t, w{k - 1} w WHERE NOT v)),
w{k} AS MATERIALIZED (
  SELECT w.a - {RATE} * (g.a + {REG} * w.a) AS a, w.b - {RATE} * (g.b + {REG} * w.b) AS b, w.c - {RATE} * g.c AS c, g.loss FROM w{k - 1} w, g{k} g)""")
    every = " UNION ALL ".join(f"SELECT {k} AS step, * FROM w{k}" for k in range(ROUNDS + 1))
    chain = ",\n".join(steps)
    return f"""
WITH t AS MATERIALIZED (
  SELECT ln(1.0 + n_chars) / 10 AS x1, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS x2, quality AS y, d.doc_id % 5 = 0 AS v
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
{chain},
w AS ({every}),
p AS (SELECT step, y, CASE WHEN a * x1 + b * x2 + c > 0 THEN 1 ELSE 0 END AS q, count(*) AS n FROM t, w WHERE v GROUP BY ALL),
k AS (SELECT step, c.c AS class, sum(n) FILTER (y = c.c AND q = c.c) AS tp, sum(n) FILTER (y = c.c) AS t, sum(n) FILTER (q = c.c) AS p
      FROM p, (VALUES (0), (1)) c(c) GROUP BY ALL),
f AS (SELECT step, sum(coalesce(2 * tp / (coalesce(t, 0) + coalesce(p, 0)), 0) * coalesce(t, 0)) / sum(t) AS eval_f1,
             sum(coalesce(tp, 0)) / sum(t) AS accuracy FROM k GROUP BY step),
o AS (SELECT w.*, accuracy, eval_f1, max(eval_f1) OVER (ORDER BY w.step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM w JOIN f ON w.step = f.step),
b AS (SELECT *, max(CASE WHEN before IS NULL OR eval_f1 > before THEN step END) OVER (ORDER BY step) AS latest FROM o),
e AS (SELECT *, min(CASE WHEN step - latest >= 3 THEN step END) OVER () AS stop FROM b),
s AS (SELECT *, max(latest) OVER () AS best FROM e WHERE stop IS NULL OR step <= stop)
SELECT step::BIGINT AS step, round(loss, 6) AS train_loss, round(accuracy, 6) AS accuracy, round(eval_f1, 6) AS eval_f1, step = best AS best,
       CASE WHEN step = best THEN round(a, 6) END AS x1, CASE WHEN step = best THEN round(b, 6) END AS x2,
       CASE WHEN step = best THEN round(c, 6) END AS constant
FROM s"""


@query("mdl_11_rounds", rounds_sql())
def training_rounds(spark, sf_dir):
    """The log of a training in rounds, with the weights that it ends with."""
    rows = two_features(spark, sf_dir)
    found = rounds.train_rounds(
        rows.filter(~F.col("check")), rows.filter("check"), new_path(spark, "rounds"), rounds.plain_features(["x1", "x2"]), 2,
        rounds=ROUNDS, rate=RATE, reg=REG,
    )
    best = F.col("step") == found.best_round
    weights = [F.when(best, F.lit(float(w))).alias(n) for n, w in zip(("x1", "x2", "constant"), found.weights[1], strict=True)]
    return rounded(found.log.select("step", "train_loss", "accuracy", "eval_f1", best.alias("best"), *weights))


def shares_by_language(path: str):
    """Loader of a bundle of JSON lines: the labels counted by language, as a model."""
    counts = {}
    for name in os.listdir(path):
        if name.endswith(".json"):
            with open(f"{path}/{name}") as lines:
                counts |= {r.get("lang"): (r["bad"] + 1, r["good"] + 1) for r in map(json.loads, lines)}

    def score(batch: pa.RecordBatch) -> np.ndarray:
        return np.log([counts.get(lang, (1, 1)) for lang in batch.column("lang").to_pylist()])

    return score


@query("mdl_02_external", """
WITH c AS (SELECT lang, count(*) FILTER (quality = 0) + 1 AS bad, count(*) FILTER (quality = 1) + 1 AS good
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang),
s AS (SELECT doc_id, coalesce(bad, 1) / (coalesce(bad, 1) + coalesce(good, 1)) AS bad FROM documents d LEFT JOIN c ON d.lang = c.lang)
SELECT doc_id, CASE WHEN bad >= 0.5 THEN 'bad' ELSE 'good' END AS predicted_class, round(greatest(bad, 1 - bad), 6) AS confidence,
       round(bad, 6) AS p_bad, round(1 - bad, 6) AS p_good, 'bad,good' AS class_names FROM s""")
def external_model(spark, sf_dir):
    """Documents scored by a model that is not Spark's: its bundle is a folder of counts."""
    path = new_path(spark, "bundle")
    bad = labelled(spark, sf_dir).groupBy("lang").agg(F.count_if(F.col("label") == 0).alias("bad"), F.count_if(F.col("label") == 1).alias("good"))
    bad.coalesce(1).write.json(path)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    found = external.predict_external(docs, path, shares_by_language, ["bad", "good"], ["lang"], 100, logits=True)
    p = "prediction"
    return rounded(found.select(
        "doc_id", f"{p}.predicted_class", f"{p}.confidence", F.col(f"{p}.all_probabilities")[0].alias("p_bad"),
        F.col(f"{p}.all_probabilities")[1].alias("p_good"), F.array_join(f"{p}.class_names", ",").alias("class_names"),
    ))


THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]


def halving_sql() -> str:
    trials = ", ".join(f"({i}, {t}::DOUBLE)" for i, t in enumerate(THRESHOLDS))
    rungs, names = [], []
    for r, fraction in enumerate((0.25, 0.5, 1.0)):
        among = f"(SELECT o.* FROM o JOIN l{r - 1} k ON o.trial = k.trial_number WHERE k.kept)" if r else "o"
        rungs.append(f"""
r{r} AS (SELECT o.trial, y_true, CASE WHEN score >= o.threshold THEN 1 ELSE 0 END AS q FROM s, {among} o WHERE rn <= ceil(c * {fraction})),
k{r} AS (SELECT trial, c.c AS class, count(*) FILTER (y_true = c.c AND q = c.c) AS tp, count(*) FILTER (y_true = c.c) AS t,
                count(*) FILTER (q = c.c) AS p FROM r{r}, (VALUES (0), (1)) c(c) GROUP BY ALL),
f{r} AS (SELECT trial, sum(CASE WHEN t + p > 0 THEN 2.0 * tp / (t + p) ELSE 0 END * t) / sum(t) AS value, sum(t) AS n FROM k{r} GROUP BY trial),
l{r} AS (SELECT {r} AS rung, trial AS trial_number, n, value,
                row_number() OVER (ORDER BY round(value, 9) DESC, trial) <= ceil(count(*) OVER () / 2) AS kept FROM f{r})""")
        names.append(f"SELECT rung, trial_number, n, round(value, 6) AS value, kept FROM l{r}")
    return f"""
WITH {scored_sql()},
o(trial, threshold) AS (VALUES {trials}),
s AS (SELECT y_true, score, row_number() OVER (PARTITION BY y_true ORDER BY md5('42:' || id), id) AS rn, count(*) OVER (PARTITION BY y_true) AS c FROM scored),
{','.join(rungs)}
{' UNION ALL '.join(names)}"""


@query("mdl_06_halving", halving_sql())
def threshold_halving(spark, sf_dir):
    """The ledger of a search for a threshold on made-up scores."""

    def evaluate(sample, params):
        rows = sample.withColumn("y_pred", (F.col("score") >= params["threshold"]).cast("int"))
        return E.metrics(rows).first()["f1"]

    trials = [{"threshold": t} for t in THRESHOLDS]
    rows = scored(spark, sf_dir).select("id", "y_true", "score")
    found = halving.successive_halving(rows, trials, evaluate, new_path(spark, "halving"), by=["y_true"])
    return rounded(found.select("rung", "trial_number", "n", "value", "kept"))


@query("mdl_06_tune_by_halving", """
WITH t AS (SELECT unnest([0, 1, 2]) AS rung, unnest([4, 2, 1]) AS trials)
SELECT rung, trials, true AS in_range, true AS nested, true AS best_is_fitted FROM t""")
def tune_by_halving(spark, sf_dir):
    """Search and final fit of a text classifier: trials per rung, values in range, growing samples, parameters of the fit."""
    rows = parts(spark, sf_dir)
    space = {"regParam": (1e-4, 1e-1), "numFeatures": [1 << 10, 1 << 12], "maxIter": (3, 6)}
    found, model = halving.tune_by_halving(part(rows, "train"), part(rows, "validation"), new_path(spark, "halving"), 4, space=space)
    best = halving.best_params(found)
    fitted = (model.stages[1].getNumFeatures(), model.stages[-1].getRegParam(), model.stages[-1].getMaxIter())
    same = fitted == (best["numFeatures"], best["regParam"], best["maxIter"])
    whole = part(rows, "train").count()
    sizes = F.col("n").between(math.floor(whole / 4), whole)
    return found.groupBy("rung").agg(
        F.count("*").alias("trials"),
        F.every(F.col("value").between(0, 1) & F.col("error").isNull()).alias("in_range"),
        F.every(sizes).alias("nested"),
        F.lit(same).alias("best_is_fitted"),
    )


REPLICATES = 100


def bootstrap_sql() -> str:
    draw = "(('0x' || substr(md5('42:' || block || ':' || id), 8 * k + 1, 8))::BIGINT / 4294967296.0)"
    count = " + ".join(f"({draw} >= {p!r})::BIGINT" for p in bootstrap.POISSON)
    return f"""
WITH {scored_sql(7919, "one")}, {scored_sql(104729, "two")},
d AS (SELECT one.id, one.y_true, one.y_pred AS a, two.y_pred AS b, one.score AS sa, two.score AS sb FROM one JOIN two ON one.id = two.id),
w AS (SELECT 4 * block + k AS rep, d.*, {count} AS n
      FROM d, (SELECT unnest(range(0, {REPLICATES // 4})) AS block), (SELECT unnest(range(0, 4)) AS k)
      UNION ALL SELECT -1 AS rep, d.*, 1 AS n FROM d),
m AS (SELECT rep, 'first' AS model, y_true, a AS q, least(floor(sa * 1000), 999) AS bin, n FROM w WHERE n > 0
      UNION ALL SELECT rep, 'second', y_true, b, least(floor(sb * 1000), 999), n FROM w WHERE n > 0),
c AS (SELECT rep, model, c.c AS class, coalesce(sum(n) FILTER (y_true = c.c AND q = c.c), 0) AS tp, coalesce(sum(n) FILTER (y_true = c.c), 0) AS t,
             coalesce(sum(n) FILTER (q = c.c), 0) AS p FROM m, (VALUES (0), (1)) c(c) GROUP BY ALL),
f AS (SELECT rep, model, sum(tp) / sum(t) AS accuracy, sum(CASE WHEN t + p > 0 THEN 2.0 * tp / (t + p) ELSE 0 END * t) / sum(t) AS f1 FROM c GROUP BY ALL),
s AS (SELECT rep, model, bin, coalesce(sum(n) FILTER (y_true = 1), 0) AS pos, coalesce(sum(n) FILTER (y_true <> 1), 0) AS neg FROM m GROUP BY ALL),
u AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY rep, model ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s),
r AS (SELECT rep, model, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM u GROUP BY ALL),
l AS (SELECT f.rep, f.model, unnest(['accuracy', 'f1', 'auc']) AS metric, unnest([accuracy, f1, auc]) AS v FROM f JOIN r ON f.rep = r.rep AND f.model = r.model),
g AS (SELECT rep, metric, max(v) FILTER (model = 'first') AS a, max(v) FILTER (model = 'second') AS b FROM l GROUP BY ALL)
SELECT metric, round(max(a) FILTER (rep < 0), 6) AS first, round(max(b) FILTER (rep < 0), 6) AS second,
       round(max(b - a) FILTER (rep < 0), 6) AS difference,
       round(quantile_cont(b - a, 0.025) FILTER (rep >= 0), 6) AS low, round(quantile_cont(b - a, 0.975) FILTER (rep >= 0), 6) AS high,
       count(b - a) FILTER (rep >= 0) AS replicates,
       quantile_cont(b - a, 0.025) FILTER (rep >= 0) > 0 OR quantile_cont(b - a, 0.975) FILTER (rep >= 0) < 0 AS significant
FROM g GROUP BY metric"""


@query("evl_22_bootstrap", bootstrap_sql())
def bootstrap_difference(spark, sf_dir):
    """Intervals of the differences of two made-up models."""
    return rounded(bootstrap.bootstrap_difference(scored(spark, sf_dir), scored(spark, sf_dir, 104729), REPLICATES))
