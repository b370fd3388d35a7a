"""Queries on evaluation (EVL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgrove.operators import evaluate as E
from textgrove.queries.common import (
    MULTICLASS,
    multiclass,
    query,
    rounded,
    scored,
    scored_models,
    scored_models_sql,
    scored_sql,
    table,
)
from textgrove.queries.profile import DESCRIBE, histogram_sql
from textgrove.queries.split import THREE_WAY

RIGHT = "CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END"


def per_class_sql(source: str, by: str = "", name: str = "per_class") -> str:
    """Per-class metrics of a DuckDB relation, optionally per group."""
    keys = f"{by}, " if by else ""
    on = f"AND a.{by} = c.{by}" if by else ""
    return f"""
{name} AS (
  SELECT *, CASE WHEN p > 0 THEN CAST(tp AS DOUBLE) / p ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0 END AS recall,
         CASE WHEN p + support > 0 THEN 2.0 * tp / (p + support) ELSE 0 END AS f1
  FROM (SELECT {'c.' + by + ', ' if by else ''}c.class, count(*) FILTER (a.y_true = c.class) AS support,
               count(*) FILTER (a.y_pred = c.class) AS p,
               count(*) FILTER (a.y_true = c.class AND a.y_pred = c.class) AS tp
        FROM (SELECT {keys}y_true AS class FROM {source} UNION SELECT {keys}y_pred FROM {source}) c
        JOIN {source} a ON (a.y_true = c.class OR a.y_pred = c.class) {on}
        GROUP BY ALL))"""


def metrics_sql(source: str, by: str = "", name: str = "metrics") -> str:
    """Weighted metrics of a DuckDB relation, optionally per group."""
    keys = f"{by}, " if by else ""
    weighted = ", ".join(
        f"sum({m} * support) / sum(support) AS {m}" for m in ("precision", "recall", "f1")
    )
    return per_class_sql(source, by, f"{name}_pc") + f""",
{name} AS (
  SELECT {keys}CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy, {weighted},
         CAST(sum(support) AS BIGINT) AS n
  FROM {name}_pc {f'GROUP BY {by}' if by else ''})"""


M = "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"


@query("evl_01_accuracy", f"WITH {scored_sql()} SELECT round(avg({RIGHT}), 6) AS accuracy FROM scored")
def accuracy(spark, sf_dir):
    return rounded(E.metrics(scored(spark, sf_dir)).select("accuracy"))


@query("evl_02_weighted_metrics", f"WITH {scored_sql()}, {metrics_sql('scored')} SELECT {M}, n FROM metrics")
def weighted_metrics(spark, sf_dir):
    return rounded(E.metrics(scored(spark, sf_dir)))


@query("evl_02_multiclass_metrics", f"WITH {MULTICLASS}, {metrics_sql('multiclass')} SELECT {M}, n FROM metrics")
def multiclass_metrics(spark, sf_dir):
    return rounded(E.metrics(multiclass(spark, sf_dir)))


PER_CLASS = """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM per_class"""


@query("evl_03_per_class", f"WITH {scored_sql()}, {per_class_sql('scored')} {PER_CLASS}")
def per_class(spark, sf_dir):
    return rounded(E.per_class(scored(spark, sf_dir)).drop("tp"))


@query("evl_03_per_class_multiclass", f"WITH {MULTICLASS}, {per_class_sql('multiclass')} {PER_CLASS}")
def per_class_multiclass(spark, sf_dir):
    return rounded(E.per_class(multiclass(spark, sf_dir)).drop("tp"))


CONFUSION = """
classes AS (SELECT y_true AS c FROM {0} UNION SELECT y_pred FROM {0}),
cells AS (SELECT a.c AS y_true, b.c AS y_pred,
                 (SELECT count(*) FROM {0} s WHERE s.y_true = a.c AND s.y_pred = b.c) AS n
          FROM classes a, classes b)"""


@query("evl_04_confusion", f"""
WITH {MULTICLASS}, {CONFUSION.format('multiclass')} SELECT y_true, y_pred, n FROM cells""")
def confusion(spark, sf_dir):
    return E.confusion(multiclass(spark, sf_dir)).drop("share")


@query("evl_04_confusion_wide", f"""
WITH {scored_sql()}
SELECT y_true, count(*) FILTER (y_pred = 0) AS pred_0, count(*) FILTER (y_pred = 1) AS pred_1
FROM scored GROUP BY y_true""")
def confusion_wide(spark, sf_dir):
    return E.confusion_wide(scored(spark, sf_dir), [0, 1])


@query("evl_05_confusion_normalised", f"""
WITH {scored_sql()}, {CONFUSION.format('scored')}
SELECT y_true, y_pred, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY y_true), 6) AS share FROM cells""")
def confusion_normalised(spark, sf_dir):
    return rounded(E.confusion(scored(spark, sf_dir)))


def roc_sql(source: str) -> str:
    return f"""
p AS (SELECT score, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true <> 1) AS neg
      FROM {source} GROUP BY score),
c AS (SELECT score AS threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
             sum(pos) OVER () AS ps, sum(neg) OVER () AS ns FROM p WINDOW w AS (ORDER BY score DESC)),
roc AS (SELECT round(CAST(fp AS DOUBLE) / ns, 6) AS fpr, round(CAST(tp AS DOUBLE) / ps, 6) AS tpr,
               round(threshold, 6) AS threshold FROM c
        UNION ALL SELECT 0.0, 0.0, NULL)"""


def auc_sql(source: str) -> str:
    """Share of (positive, negative) pairs in the right order, ties half, by average ranks."""
    return f"""
ranks AS (SELECT y_true, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM {source}),
auc AS (SELECT (sum(r) FILTER (y_true = 1) - k * (k + 1) / 2.0) / (k * (n - k)) AS roc_auc
        FROM ranks, (SELECT CAST(count(*) FILTER (y_true = 1) AS DOUBLE) AS k, count(*) AS n FROM {source}) GROUP BY k, n)"""


# Prices as scores of "was the item returned": many distinct values.
RETURNS = """
returns AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
                   CAST(l_extendedprice AS DOUBLE) AS score FROM lineitem)"""


def returns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        F.col("l_extendedprice").cast("double").alias("score"),
    )


@query("evl_06_roc_points", f"WITH {scored_sql()}, {roc_sql('scored')} SELECT * FROM roc")
def roc_points(spark, sf_dir):
    return rounded(E.roc_points(scored(spark, sf_dir)))


@query("evl_06_roc_points_large", f"WITH {RETURNS}, {roc_sql('returns')} SELECT * FROM roc")
def roc_points_large(spark, sf_dir):
    return rounded(E.roc_points(returns(spark, sf_dir)))


@query("evl_07_roc_auc", f"WITH {scored_sql()}, {auc_sql('scored')} SELECT round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc(spark, sf_dir):
    return rounded(E.roc_auc(scored(spark, sf_dir)))


@query("evl_07_roc_auc_large", f"WITH {RETURNS}, {auc_sql('returns')} SELECT round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc_large(spark, sf_dir):
    return rounded(E.roc_auc(returns(spark, sf_dir)))


@query("evl_08_errors", f"WITH {scored_sql()} SELECT id, text, y_true, y_pred FROM scored WHERE y_true <> y_pred")
def errors(spark, sf_dir):
    return E.errors(scored(spark, sf_dir)).select("id", "text", "y_true", "y_pred")


@query("evl_09_error_rate", f"""
WITH {scored_sql()} SELECT count(*) FILTER (y_true <> y_pred) AS incorrect,
       round(1 - avg({RIGHT}), 6) AS error_rate FROM scored""")
def error_rate(spark, sf_dir):
    return rounded(E.error_rate(scored(spark, sf_dir)).select("incorrect", "error_rate"))


@query("evl_10_error_patterns", f"""
WITH {MULTICLASS} SELECT y_true || ' -> ' || y_pred AS pattern, count(*) AS n
FROM multiclass WHERE y_true <> y_pred GROUP BY pattern ORDER BY n DESC, pattern""")
def error_patterns(spark, sf_dir):
    return E.error_patterns(multiclass(spark, sf_dir))


@query("evl_11_error_examples", f"""
WITH {scored_sql()} SELECT id, left(text, 200) || '...' AS preview, y_true, y_pred, round(score, 3) AS confidence
FROM scored WHERE y_true <> y_pred ORDER BY id LIMIT 10""")
def error_examples(spark, sf_dir):
    return E.error_examples(scored(spark, sf_dir), 10)


@query("evl_11_confident_errors", f"""
WITH {scored_sql()} SELECT id, left(text, 200) || '...' AS preview, y_true, y_pred, round(score, 3) AS confidence
FROM scored WHERE y_true <> y_pred ORDER BY greatest(score, 1 - score) DESC, id LIMIT 10""")
def confident_errors(spark, sf_dir):
    return E.error_examples(scored(spark, sf_dir), 10, confident_first=True)


@query("evl_12_correct_counts", f"""
WITH {scored_models_sql()} SELECT model, count(*) FILTER (y_true = y_pred) AS correct,
       count(*) FILTER (y_true <> y_pred) AS incorrect FROM models GROUP BY model""")
def correct_counts(spark, sf_dir):
    return E.error_rate(scored_models(spark, sf_dir), ["model"]).select("model", "correct", "incorrect")


@query("evl_13_score_histogram", histogram_sql(
    "SELECT CAST((l.doc_id * 7919) % 61 + 40 * l.quality AS DOUBLE) / 100.0 AS v"
    " FROM labels l JOIN documents d ON d.doc_id = l.doc_id", 30))
def score_histogram(spark, sf_dir):
    return rounded(E.score_histogram(scored(spark, sf_dir)))


@query("evl_14_confidence_points", f"""
WITH {scored_sql()} SELECT id, round(score, 6) AS score, CAST({RIGHT} AS INTEGER) AS correct FROM scored""")
def confidence_points(spark, sf_dir):
    return rounded(E.confidence_points(scored(spark, sf_dir)))


@query("evl_14_reliability", f"""
WITH {scored_sql()} SELECT CAST(least(floor(score * 10), 9) AS INTEGER) AS band, count(*) AS n,
       round(avg(score), 6) AS mean_score, round(avg({RIGHT}), 6) AS accuracy FROM scored GROUP BY 1""")
def reliability(spark, sf_dir):
    return rounded(E.reliability(scored(spark, sf_dir)))


# Facts about the three made-up models: parameters in millions and minutes of training.
FACTS = [("first", 66, 45.0), ("second", 110, 75.0), ("third", 125, 82.0)]
FACTS_SQL = "facts(model, parameters, train_min) AS (VALUES " + ", ".join(
    f"('{m}', {p}, CAST({t} AS DOUBLE))" for m, p, t in FACTS
) + ")"


def comparison(spark, sf_dir):
    facts = spark.createDataFrame(FACTS, "model string, parameters int, train_min double")
    return E.compare_models(scored_models(spark, sf_dir), facts)


@query("evl_15_compare_models", f"""
WITH {scored_models_sql()}, {metrics_sql('models', 'model')}, {FACTS_SQL}
SELECT m.model, {M}, n, f.parameters, f.train_min FROM metrics m LEFT JOIN facts f ON m.model = f.model""")
def compare_models(spark, sf_dir):
    return rounded(comparison(spark, sf_dir))


@query("evl_16_per_language", f"""
WITH {scored_sql()}, {metrics_sql('scored', 'lang')},
b AS (SELECT accuracy AS ba, f1 AS bf FROM metrics WHERE lang = 'en')
SELECT lang, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, n,
       round(accuracy * 100 / ba, 6) AS accuracy_pct_of_base, round(f1 * 100 / bf, 6) AS f1_pct_of_base
FROM metrics, b""")
def per_language(spark, sf_dir):
    return rounded(E.per_language(scored(spark, sf_dir)))


@query("evl_17_adaptation", f"""
WITH {scored_sql(7919, 'zero')}, {scored_sql(104729, 'tuned')},
z AS (SELECT lang, avg({RIGHT}) AS a FROM zero GROUP BY lang),
t AS (SELECT lang, avg({RIGHT}) AS a FROM tuned GROUP BY lang)
SELECT z.lang, round(z.a, 6) AS zero_shot, round(t.a, 6) AS fine_tuned, round(t.a - z.a, 6) AS difference
FROM z JOIN t ON z.lang = t.lang""")
def adaptation(spark, sf_dir):
    return rounded(E.compare_adaptation(scored(spark, sf_dir), scored(spark, sf_dir, 104729)))


@query("evl_18_per_class_table", f"""
WITH {scored_sql()}, {per_class_sql('scored')}
SELECT CASE class WHEN 0 THEN 'NEGATIVE' WHEN 1 THEN 'POSITIVE' END AS class_name,
       round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM per_class""")
def per_class_table(spark, sf_dir):
    from textgrove.sources.catalogue import DATASETS

    return E.per_class_table(scored(spark, sf_dir), DATASETS["imdb"].class_names)


@query("evl_19_evaluate_split", f"""
WITH {THREE_WAY},
s AS (SELECT label AS y_true, CASE WHEN CAST((id * 7919) % 61 + 40 * label AS DOUBLE) / 100.0 >= 0.5
             THEN 1 ELSE 0 END AS y_pred FROM three_way WHERE split = 'validation'),
{metrics_sql('s')}
SELECT 'validation' AS dataset, n AS num_samples, {M} FROM metrics""")
def evaluate_split(spark, sf_dir):
    from textgrove.operators.split import three_way_split

    rows = scored(spark, sf_dir).select("id", "y_true", "y_pred")
    return rounded(E.evaluate_split(three_way_split(rows, "id", "y_true"), "validation"))


@query("evl_20_confidence_by_outcome", f"""
WITH {scored_sql()}, m AS (SELECT CAST({RIGHT} AS INTEGER) AS correct, score AS v FROM scored)
SELECT correct, {DESCRIBE} FROM m GROUP BY correct""")
def confidence_by_outcome(spark, sf_dir):
    return rounded(E.confidence_by_outcome(scored(spark, sf_dir)))


@query("evl_21_accuracy_by_length", f"""
WITH {scored_sql()}, m AS (SELECT *, length(text) AS chars FROM scored)
SELECT CASE WHEN chars >= 5000 THEN 3 WHEN chars >= 1000 THEN 2 WHEN chars >= 200 THEN 1 ELSE 0 END AS band,
       count(*) AS n, CAST(min(chars) AS INTEGER) AS shortest, CAST(max(chars) AS INTEGER) AS longest,
       round(avg({RIGHT}), 6) AS accuracy FROM m GROUP BY 1""")
def accuracy_by_length(spark, sf_dir):
    measured = scored(spark, sf_dir).withColumn("chars", F.length("text"))
    return rounded(E.accuracy_by_length(measured, [200, 1000, 5000]))


@query("evl_22_mcnemar", f"""
WITH {scored_sql(7919, 'a')}, {scored_sql(104729, 'b')},
j AS (SELECT a.y_true = a.y_pred AS ra, b.y_true = b.y_pred AS rb FROM a JOIN b ON a.id = b.id),
c AS (SELECT count(*) FILTER (ra AND NOT rb) AS only_first, count(*) FILTER (rb AND NOT ra) AS only_second FROM j),
s AS (SELECT *, CASE WHEN only_first + only_second > 0
      THEN pow(abs(only_first - only_second) - 1, 2) / (only_first + only_second) END AS st FROM c)
SELECT only_first, only_second, round(st, 6) AS statistic, coalesce(st > 3.841, false) AS significant FROM s""")
def mcnemar(spark, sf_dir):
    return rounded(E.mcnemar(scored(spark, sf_dir), scored(spark, sf_dir, 104729)))


@query("evl_25_relative_models", f"""
WITH {scored_models_sql()}, {metrics_sql('models', 'model')}, {FACTS_SQL},
j AS (SELECT m.model, m.accuracy, f.parameters FROM metrics m JOIN facts f ON m.model = f.model),
b AS (SELECT accuracy AS ba, parameters AS bp FROM j WHERE model = 'second')
SELECT model, round(accuracy, 6) AS accuracy, parameters,
       round(accuracy * 100 / ba, 6) AS accuracy_pct_of_base,
       round(parameters * 100.0 / bp, 6) AS parameters_pct_of_base FROM j, b""")
def relative_models(spark, sf_dir):
    columns = ["accuracy", "parameters"]
    table_ = comparison(spark, sf_dir).select("model", *columns)
    return rounded(E.relative_to(table_, "second", columns))


# Scored rows in which some predictions, scores and labels are missing.
GAPS = """
gaps AS (
  SELECT id, CASE WHEN id % 13 = 0 THEN NULL ELSE y_true END AS y_true,
         CASE WHEN id % 7 = 0 THEN NULL ELSE y_pred END AS y_pred,
         CASE WHEN id % 11 = 0 THEN NULL ELSE score END AS score FROM scored)"""


def gaps(spark, sf_dir):
    hole = lambda c, n: F.when(F.col("id") % n != 0, F.col(c)).alias(c)
    return scored(spark, sf_dir).select("id", hole("y_true", 13), hole("y_pred", 7), hole("score", 11))


@query("evl_01_accuracy_gaps", f"""
WITH {scored_sql()}, {GAPS}
SELECT count(*) AS n, round(avg(CASE WHEN y_true IS NOT DISTINCT FROM y_pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM gaps""")
def accuracy_gaps(spark, sf_dir):
    return rounded(E.metrics(gaps(spark, sf_dir)).select("n", "accuracy"))


@query("evl_04_confusion_gaps", f"""
WITH {scored_sql()}, {GAPS},
c AS (SELECT y_true AS c FROM gaps UNION SELECT y_pred FROM gaps)
SELECT a.c AS y_true, b.c AS y_pred, count(g.id) AS n
FROM c a CROSS JOIN c b LEFT JOIN gaps g ON g.y_true IS NOT DISTINCT FROM a.c AND g.y_pred IS NOT DISTINCT FROM b.c
GROUP BY ALL""")
def confusion_gaps(spark, sf_dir):
    return E.confusion(gaps(spark, sf_dir)).select("y_true", "y_pred", "n")


@query("evl_07_roc_auc_gaps", f"""
WITH {scored_sql()}, {GAPS},
r AS (SELECT * FROM gaps WHERE score IS NOT NULL AND y_true IS NOT NULL)
SELECT round(avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END), 6) AS roc_auc
FROM r p JOIN r q ON p.y_true = 1 AND q.y_true = 0""")
def roc_auc_gaps(spark, sf_dir):
    return rounded(E.roc_auc(gaps(spark, sf_dir)))


@query("evl_06_unranked", f"""
WITH {scored_sql()}, {GAPS}
SELECT count(*) - count(score) AS no_score, count(*) - count(y_true) AS no_label, count(*) AS n FROM gaps""")
def unranked(spark, sf_dir):
    return E.unranked(gaps(spark, sf_dir))


@query("evl_08_errors_gaps", f"""
WITH {scored_sql()}, {GAPS} SELECT id FROM gaps WHERE y_true IS DISTINCT FROM y_pred""")
def errors_gaps(spark, sf_dir):
    return E.errors(gaps(spark, sf_dir)).select("id")


@query("evl_09_error_rate_gaps", f"""
WITH {scored_sql()}, {GAPS}
SELECT count(*) AS n, count(*) FILTER (y_true IS DISTINCT FROM y_pred) AS incorrect,
       count(*) FILTER (y_true IS NOT DISTINCT FROM y_pred) AS correct FROM gaps""")
def error_rate_gaps(spark, sf_dir):
    return E.error_rate(gaps(spark, sf_dir)).select("n", "incorrect", "correct")


@query("evl_10_error_patterns_gaps", f"""
WITH {scored_sql()}, {GAPS}
SELECT coalesce(y_true::VARCHAR, 'null') || ' -> ' || coalesce(y_pred::VARCHAR, 'null') AS pattern, count(*) AS n
FROM gaps WHERE y_true IS DISTINCT FROM y_pred GROUP BY 1""")
def error_patterns_gaps(spark, sf_dir):
    return E.error_patterns(gaps(spark, sf_dir))
