"""Evaluation of predictions: metrics, curves, errors, comparisons.

The input is a table of scored rows, by default with the columns ``id``,
``y_true``, ``y_pred`` and ``score`` (probability of the positive class).
Everything class-based starts from the counts of (true, predicted) pairs, so
that one aggregation with map-side combining is the only pass over the rows.

Nulls follow one rule: a null is a class of its own, equal only to a null. A
row without a prediction is an error everywhere, has its cell in the confusion
matrix and counts in every n. Curves rank only rows with a score and a label;
``unranked`` counts the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrove.functions.text import label_name, preview
from textgrove.operators.profile import describe, histogram
from textgrove.operators.scale import match, running_totals

MCNEMAR_CRITICAL = 3.841  # chi-squared, one degree of freedom, 5 %


def is_right() -> Column:
    """Whether the predicted class is the true one; never null."""
    return F.col("y_true").eqNullSafe(F.col("y_pred"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def pair_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per true and predicted class."""
    return scored.groupBy(*(by or []), "y_true", "y_pred").agg(F.count("*").alias("n"))


def per_class(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support of every class seen or predicted (EVL-3)."""
    return per_class_of(pair_counts(scored, by), by or [])


def per_class_of(counts: DataFrame, by: list[str]) -> DataFrame:
    """``per_class`` from ``n`` rows of each true and predicted class."""
    hit = F.when(is_right(), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y_true").alias("class"), hit.alias("tp"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p")),
        F.struct(F.col("y_pred").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p")),
    )
    sums = (
        counts.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("tp", "t", "p")])
    )
    precision = _ratio(F.col("tp"), F.col("p"))
    recall = _ratio(F.col("tp"), F.col("t"))
    return sums.select(
        *by,
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * F.col("tp"), F.col("t") + F.col("p")).alias("f1"),
        F.col("t").alias("support"),
        "tp",
    )


def metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (EVL-1, EVL-2)."""
    return metrics_of(pair_counts(scored, by), by or [])


def metrics_of(counts: DataFrame, by: list[str]) -> DataFrame:
    """``metrics`` from ``n`` rows of each true and predicted class."""
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    return (
        per_class_of(counts, by)
        .groupBy(*by)
        .agg(
            (F.sum("tp") / F.sum("support")).alias("accuracy"),
            weighted("precision"),
            weighted("recall"),
            weighted("f1"),
            F.sum("support").alias("n"),
        )
    )


def per_class_table(scored: DataFrame, names: list[str], digits: int = 4) -> DataFrame:
    """Per-class metrics with class names, rounded (EVL-18)."""
    table = per_class(scored)
    return table.select(
        label_name(F.col("class"), names).alias("class_name"),
        *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")],
        "support",
    )


def confusion(scored: DataFrame) -> DataFrame:
    """All cells of the confusion matrix with row-normalised shares (EVL-4, EVL-5).

    A row without true members has null shares. Null is a class if there is one,
    and the cells add up to the number of rows.
    """
    counts = pair_counts(scored)
    found = F.array_distinct(F.flatten(F.collect_list(F.array("y_true", "y_pred"))))
    classes = counts.agg(F.array_sort(found).alias("c"))
    grid = classes.select(F.explode("c").alias("y_true"), "c").select("y_true", F.explode("c").alias("y_pred"))
    rows = counts.groupBy("y_true").agg(F.sum("n").alias("_row"))
    cells = match(match(grid, counts, ["y_true", "y_pred"], "left"), rows, ["y_true"], "left")
    n = F.coalesce("n", F.lit(0))
    return cells.select("y_true", "y_pred", n.alias("n"), (n / F.col("_row")).alias("share"))


def confusion_wide(scored: DataFrame, classes: list) -> DataFrame:
    """Confusion matrix with one column ``pred_<class>`` per given class."""
    wide = pair_counts(scored).groupBy("y_true").pivot("y_pred", classes).agg(F.sum("n"))
    return wide.select(
        "y_true", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"pred_{c}") for c in classes]
    )


def _score_points(scored: DataFrame, score: str, positive: int) -> DataFrame:
    """Distinct scores, highest first, with the positives and negatives at and above each."""
    scored = scored.filter(F.col(score).isNotNull() & F.col("y_true").isNotNull())
    is_positive = F.col("y_true").eqNullSafe(F.lit(positive))
    counted = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg")
    )
    ordered = counted.withColumn("_down", -F.col("threshold"))
    return running_totals(ordered, ["_down"], ["pos", "neg"]).drop("_down")


def unranked(scored: DataFrame, score: str = "score") -> DataFrame:
    """Rows that curves leave out: without a score, without a label, all rows (EVL-6, EVL-7)."""
    return scored.agg(
        F.count_if(F.col(score).isNull()).alias("no_score"),
        F.count_if(F.col("y_true").isNull()).alias("no_label"),
        F.count("*").alias("n"),
    )


def roc_points(scored: DataFrame, score: str = "score", positive: int = 1) -> DataFrame:
    """ROC curve (EVL-6): one point per distinct score and the origin, ties merged."""
    share = lambda part, whole: F.when(F.col(whole) > 0, part / F.col(whole))
    curve = _score_points(scored, score, positive).select(
        share(F.col("neg_before") + F.col("neg"), "neg_total").alias("fpr"),
        share(F.col("pos_before") + F.col("pos"), "pos_total").alias("tpr"),
        "threshold",
    )
    origin = scored.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    return curve.unionByName(origin)


def roc_auc(scored: DataFrame, score: str = "score", positive: int = 1) -> DataFrame:
    """Area under the ROC curve (EVL-7), null unless exactly two classes are present."""
    points = _score_points(scored, score, positive)
    higher = F.col("pos_before") + F.col("pos") / 2
    won = F.sum(F.col("neg").cast("double") * higher)
    area = won / (F.sum("pos").cast("double") * F.sum("neg").cast("double"))
    classes = scored.agg(F.count_distinct("y_true")).scalar()
    return points.agg(
        F.when((F.sum("pos") > 0) & (F.sum("neg") > 0), area).alias("area")
    ).select(F.when(classes == 2, F.col("area")).alias("roc_auc"))


def errors(scored: DataFrame) -> DataFrame:
    """Misclassified rows (EVL-8)."""
    return scored.filter(~is_right())


def error_rate(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, errors, correct rows and error rate (EVL-9, EVL-12)."""
    wrong = F.count_if(~is_right())
    return scored.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        wrong.alias("incorrect"),
        (F.count("*") - wrong).alias("correct"),
        (wrong / F.count("*")).alias("error_rate"),
    )


def error_patterns(scored: DataFrame) -> DataFrame:
    """Errors per ``true -> predicted`` pattern, most frequent first (EVL-10)."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    pattern = F.concat_ws(" -> ", named("y_true"), named("y_pred"))
    return (
        errors(scored)
        .groupBy(pattern.alias("pattern"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "pattern")
    )


def error_examples(
    scored: DataFrame, k: int = 10, id_col: str = "id", text: str = "text", confident_first: bool = False
) -> DataFrame:
    """The first k errors with the start of the text (EVL-11)."""
    confidence = F.greatest(F.col("score"), 1 - F.col("score"))
    order = ([confidence.desc()] if confident_first else []) + [F.col(id_col)]
    return (
        errors(scored)
        .orderBy(*order)
        .limit(k)
        .select(
            id_col,
            preview(F.col(text), 200, always=True).alias("preview"),
            "y_true",
            "y_pred",
            F.round("score", 3).alias("confidence"),
        )
    )


def score_histogram(scored: DataFrame, bins: int = 30, score: str = "score") -> DataFrame:
    """Histogram of the scores (EVL-13)."""
    return histogram(scored, score, bins)


def confidence_points(scored: DataFrame, id_col: str = "id") -> DataFrame:
    """Score and correctness of every row (EVL-14)."""
    return scored.select(id_col, "score", is_right().cast("int").alias("correct"))


def reliability(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Rows, mean score and accuracy per score band of equal width in [0, 1] (EVL-14)."""
    band = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(band.alias("band")).agg(
        F.count("*").alias("n"),
        F.avg("score").alias("mean_score"),
        F.avg(is_right().cast("int")).alias("accuracy"),
    )


def compare_models(scored: DataFrame, facts: DataFrame | None = None, by: str = "model") -> DataFrame:
    """Metrics per model, next to a table of facts about the models (EVL-15)."""
    table = metrics(scored, [by])
    return table if facts is None else table.join(facts, by, "left")


def relative_to(table: DataFrame, base: str, columns: list[str], by: str = "model") -> DataFrame:
    """Each column in percent of its value for the base row (EVL-16, EVL-25)."""
    pick = F.struct(*[F.max(F.when(F.col(by) == base, F.col(c))).alias(c) for c in columns])
    values = table.agg(pick.alias("b")).scalar()
    out = table.withColumn("_base", values)
    return out.select(
        *table.columns,
        *[(F.col(c) * 100.0 / F.col(f"_base.{c}")).alias(f"{c}_pct_of_base") for c in columns],
    )


def per_language(scored: DataFrame, base: str = "en", lang: str = "lang") -> DataFrame:
    """Accuracy and F1 per language and in percent of the base language (EVL-16)."""
    table = metrics(scored, [lang]).select(lang, "accuracy", "f1", "n")
    return relative_to(table, base, ["accuracy", "f1"], lang)


def compare_adaptation(zero_shot: DataFrame, fine_tuned: DataFrame, lang: str = "lang") -> DataFrame:
    """Accuracy per language without and with own training data (EVL-17).

    A language that only one side has keeps its row; the other accuracy is null.
    """
    before = metrics(zero_shot, [lang]).select(lang, F.col("accuracy").alias("zero_shot"))
    after = metrics(fine_tuned, [lang]).select(lang, F.col("accuracy").alias("fine_tuned"))
    return before.join(after, lang, "full").withColumn("difference", F.col("fine_tuned") - F.col("zero_shot"))


def evaluate_split(scored: DataFrame, name: str = "test", split: str = "split") -> DataFrame:
    """Metrics of one split; an unknown name means the test split (EVL-19)."""
    known = name if name in ("train", "validation", "test") else "test"
    table = metrics(scored.filter(F.col(split) == known))
    return table.select(
        F.lit(known).alias("dataset"),
        F.col("n").alias("num_samples"),
        "accuracy",
        "precision",
        "recall",
        "f1",
    )


def confidence_by_outcome(scored: DataFrame) -> DataFrame:
    """Distribution of the score for right and wrong predictions (EVL-20)."""
    outcome = scored.select(is_right().cast("int").alias("correct"), "score")
    return describe(outcome, "score", ["correct"])


def accuracy_by_length(scored: DataFrame, edges: list[int], length: str = "chars") -> DataFrame:
    """Accuracy per band of text length; band i starts at the i-th edge (EVL-21)."""
    band = sum(((F.col(length) >= e).cast("int") for e in edges), F.lit(0))
    return scored.groupBy(band.alias("band")).agg(
        F.count("*").alias("n"),
        F.min(length).alias("shortest"),
        F.max(length).alias("longest"),
        F.avg(is_right().cast("int")).alias("accuracy"),
    )


def mcnemar(first: DataFrame, second: DataFrame, id_col: str = "id") -> DataFrame:
    """McNemar test on two models' predictions of the same rows (EVL-22).

    A row that one model has not predicted is a wrong prediction of that model.
    """
    right = lambda df, name: df.select(id_col, is_right().alias(name))
    both = right(first, "_a").join(right(second, "_b"), id_col, "full").select(
        F.coalesce("_a", F.lit(False)).alias("a"), F.coalesce("_b", F.lit(False)).alias("b")
    )
    b, c = F.count_if(F.col("a") & ~F.col("b")), F.count_if(~F.col("a") & F.col("b"))
    table = both.agg(b.alias("only_first"), c.alias("only_second"))
    gap = F.abs(F.col("only_first") - F.col("only_second")) - 1
    statistic = F.when(
        F.col("only_first") + F.col("only_second") > 0,
        F.pow(gap, F.lit(2)) / (F.col("only_first") + F.col("only_second")),
    )
    return table.withColumn("statistic", statistic).withColumn(
        "significant", F.coalesce(F.col("statistic") > MCNEMAR_CRITICAL, F.lit(False))
    )


def report(scored: DataFrame, name: str, score: str = "score") -> DataFrame:
    """The evaluation of one data set as a single nested row (SNK-3)."""
    classes = per_class(scored)
    listed = classes.agg(
        F.array_sort(F.collect_list(F.struct("class", "precision", "recall", "f1", "support"))).alias("c")
    ).select(F.struct(*[F.col(f"c.{m}").alias(m) for m in ("precision", "recall", "f1", "support")]).alias("v"))
    auc = roc_auc(scored, score).scalar()
    return metrics(scored).select(
        F.struct(F.lit(name).alias("name"), F.col("n").alias("size")).alias("dataset_info"),
        F.struct("accuracy", "precision", "recall", "f1", auc.alias("roc_auc")).alias("metrics"),
        listed.scalar().alias("per_class_metrics"),
    )
