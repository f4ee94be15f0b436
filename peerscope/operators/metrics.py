"""Classifier evaluation on a (score, label) table: folds, precision-recall
curve, average precision, ROC-AUC, F2-optimal threshold, classification report.

The curve needs the global order of scores.  ``ordered_stats`` aggregates to
distinct scores (ties become one curve point) and computes running counts of
positives and negatives without a single-task window; optional ``keys``
(e.g. the fold) evaluate several groups at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions import growing, round_half_even, stable_hash
from peerscope.operators.ordered import ordered_stats

F2_EPS = 1e-10
F2_FALLBACK = 0.5
N_FOLDS = 5
DIGITS = 10


def stratified_folds(df: DataFrame, label: str = "is_fraud_label", key: str = "npi", k: int = N_FOLDS) -> DataFrame:
    """M2: deterministic stratified folds 1..k.  Inside each class, rows are
    ordered by (md5-derived hash of the key, key) and dealt round-robin, so
    every fold keeps the class ratio (sizes differ by at most one per class)."""
    ordered = df.withColumn("_ord", F.struct(stable_hash(F.col(key)).alias("h"), F.col(key).alias("k")))
    st = ordered_stats(ordered, [label], "_ord").select(label, "_ord", "n_before")
    return (ordered.join(growing(st), [label, "_ord"], "inner")
            .select(key, label, ((F.col("n_before") % F.lit(k)) + F.lit(1)).cast("int").alias("fold")))


def curve_points(df: DataFrame, score: str = "score", label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score (highest first): true/false positives at
    ``score >= threshold``, precision, recall, and the counts needed for AUC."""
    keys = list(keys)
    st = ordered_stats(df, keys, score, ascending=False, measures={"pos": F.col(label).cast("long")})
    tp = F.col("pos_before") + F.col("pos")
    seen = F.col("n_before") + F.col("n")
    return st.select(
        *keys, F.col(score).alias("threshold"),
        tp.alias("tp"), (seen - tp).alias("fp"),
        F.col("pos").alias("pos_at"), (F.col("n") - F.col("pos")).alias("neg_at"),
        F.col("pos_total").alias("n_pos"), (F.col("n_total") - F.col("pos_total")).alias("n_neg"),
        (F.col("n_total") - seen - (F.col("pos_total") - tp)).alias("neg_below"),
        (tp / seen).alias("precision"),
        F.try_divide(tp.cast("double"), F.col("pos_total")).alias("recall"))


def pr_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """M12 output table with the F2 score of each point."""
    c = curve_points(df, score, label)
    return c.select("threshold", "tp", "fp", round_half_even("precision", DIGITS).alias("precision"),
                    round_half_even("recall", DIGITS).alias("recall"), round_half_even(_f2(), DIGITS).alias("f2"))


def _f2() -> Column:
    return (F.lit(5.0) * F.col("precision") * F.col("recall")) / (
        F.lit(4.0) * F.col("precision") + F.col("recall") + F.lit(F2_EPS))


def curve_metrics(df: DataFrame, score: str = "score", label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """M10 + M11 (+M15 with ``keys``): average precision sum((R_n - R_{n-1}) P_n)
    over distinct thresholds, ROC-AUC as the Mann-Whitney statistic with ties
    counted half, and the base rate."""
    keys = list(keys)
    c = curve_points(df, score, label, keys)
    g = c.groupBy(*keys).agg(
        F.sum(F.col("pos_at") * F.col("precision")).alias("_ap_num"),
        F.sum(F.col("pos_at") * (F.col("neg_below") + F.col("neg_at") / F.lit(2.0))).alias("_auc_num"),
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"))
    return g.select(
        *keys, "n_pos", "n_neg",
        round_half_even(F.try_divide("_ap_num", F.col("n_pos").cast("double")), DIGITS).alias("pr_auc"),
        round_half_even(F.try_divide("_auc_num", (F.col("n_pos") * F.col("n_neg")).cast("double")), DIGITS)
        .alias("roc_auc"),
        round_half_even(F.col("n_pos") / (F.col("n_pos") + F.col("n_neg")), DIGITS).alias("baseline"))


def f2_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Threshold maximising F2 = 5PR/(4P+R+eps); the lowest threshold wins
    ties (first maximum in ascending order); 0.5 when there is no point.  The maximum
    is taken on the unrounded value, the output is rounded."""
    c = curve_points(df, score, label).withColumn("_f2", _f2())
    best = c.orderBy(F.col("_f2").desc(), F.col("threshold").asc()).limit(1).select(
        F.col("threshold").alias("best_threshold"), round_half_even("_f2", DIGITS).alias("best_f2"))
    one = df.sparkSession.range(1)
    return one.join(best, how="left").select(
        F.coalesce("best_threshold", F.lit(F2_FALLBACK)).alias("best_threshold"),
        F.coalesce("best_f2", F.lit(0.0)).alias("best_f2"))


def classification_report(df: DataFrame, threshold: float | DataFrame, score: str = "score", label: str = "label",
                          names: tuple[str, str] = ("Normal", "Fraud")) -> DataFrame:
    """Predictions ``score >= threshold``; per-class precision, recall, F1,
    support, then accuracy, macro and support-weighted averages.  ``threshold``
    is a number or a one-row frame with ``best_threshold`` (from ``f2_threshold``)."""
    if isinstance(threshold, DataFrame):
        # one row by construction: broadcasting it is bounded
        df = df.crossJoin(F.broadcast(threshold.select("best_threshold")))
        thr = F.col("best_threshold")
    else:
        thr = F.lit(float(threshold))
    pred = (F.col(score) >= thr).cast("int")
    y = F.col(label).cast("int")
    cm = df.agg(F.count_if((pred == 1) & (y == 1)).alias("tp"), F.count_if((pred == 1) & (y == 0)).alias("fp"),
                F.count_if((pred == 0) & (y == 0)).alias("tn"), F.count_if((pred == 0) & (y == 1)).alias("fn"))

    def prf(tp, fp, fn):
        p = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
        r = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), F.lit(0.0))
        f = F.coalesce(F.try_divide(F.lit(2.0) * p * r, p + r), F.lit(0.0))
        return p, r, f

    tp, fp, tn, fn = F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")
    p0, r0, f0 = prf(tn, fn, fp)
    p1, r1, f1 = prf(tp, fp, fn)
    s0, s1 = tn + fp, tp + fn
    tot = s0 + s1
    acc = (tp + tn) / tot
    def row(pos, cls, p, r, f, sup):
        return F.struct(F.lit(pos).alias("pos"), F.lit(cls).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        sup.cast("bigint").alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        row(1, names[0], p0, r0, f0, s0),
        row(2, names[1], p1, r1, f1, s1),
        row(3, "accuracy", none, none, acc, tot),
        row(4, "macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot),
        row(5, "weighted avg", (p0 * s0 + p1 * s1) / tot, (r0 * s0 + r1 * s1) / tot, (f0 * s0 + f1 * s1) / tot, tot))
    out = cm.select(F.inline(rows))
    return out.select("pos", "class", *[round_half_even(c, DIGITS).alias(c) for c in ["precision", "recall", "f1"]],
                      F.col("support").cast("bigint").alias("support")).orderBy("pos")
