"""Scoring of predictions against labels: dedupe, points, confusion, calibration, sections, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import vocab
from ..functions.text import folded, strict_date


def first_wins(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per non-blank key, the first in the given order."""
    w = W.partitionBy(key).orderBy(*order)
    return df.where(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) != "").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    return first_wins(df, key, *[F.desc(c) for c in order])


def index_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows there are, how many without an id, how many repeat an id before them, how many ids are kept."""
    value = F.coalesce(F.trim(F.col(key).cast("string")), F.lit(""))
    per = df.groupBy(value.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    given = F.col("_id") != ""
    return per.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(~given, F.col("_n"))), F.lit(0)).alias("blank"),
        F.coalesce(F.sum(F.when(given, F.col("_n") - 1)), F.lit(0)).alias("repeated"), F.count_if(given).alias("kept"),
    )


def class_points(truth: Column, pred: Column) -> Column:
    """Points of a decision; the order of the tests matters, and what is no decision gets none."""
    return (
        F.when(~pred.isin(*vocab.DECISIONS), 0).when(truth == pred, 8).when((truth == "DENIED") & (pred == "APPROVED"), -4).when(pred == "NEEDS_REVIEW", 2)
        .when(truth == "NEEDS_REVIEW", 1).otherwise(0)
    )


def flags_key(x: Column) -> Column:
    """Flags for comparison: sorted, repeats kept, nothing as ``none``."""
    v = folded(x)
    parts = F.array_sort(F.filter(F.transform(F.split(v, r"\|"), lambda p: F.trim(p)), lambda p: p != ""))
    return F.when(v.isin("", "none", "null", "unknown"), "none").otherwise(F.array_join(parts, "|"))


def flag_set(x: Column) -> Column:
    """The distinct parts of a list; none and null are no parts, unknown is one."""
    v = folded(x)
    return F.when(v.isin("", "none", "null"), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.filter(F.transform(F.split(v, r"\|"), lambda p: F.trim(p)), lambda p: p != ""))))


def parsed_confidence(x: Column) -> Column:
    """Struct of the confidence and whether it is valid: a number from 0 to 1, else 0."""
    v = x.cast("string").try_cast("double")
    fine = F.coalesce(v.between(0, 1) & ~F.isnan(v), F.lit(False))
    return F.struct(F.when(fine, v).otherwise(0.0).alias("value"), fine.alias("valid"))


def case_scores(pairs: DataFrame, fields: dict[str, int] = vocab.FIELD_WEIGHTS) -> DataFrame:
    """One row per case with all that its score is made of.

    ``pairs`` has case_id, truth_<field> and pred_<field>, truth_adjudication,
    pred_adjudication, pred_confidence as written, present, unrecoverable (a list
    with bars) and traps.
    """
    lost = flag_set(F.col("unrecoverable"))
    results = F.array(*[_field_result(n, w, lost) for n, w in fields.items()])
    truth, pred = F.upper(F.trim(F.coalesce("truth_adjudication", F.lit("")))), F.upper(F.trim(F.coalesce("pred_adjudication", F.lit(""))))
    sure, here = parsed_confidence(F.col("pred_confidence")), F.col("present")
    right = F.when(truth == pred, 1.0).otherwise(0.0)
    reason = (
        F.when(~here, "missing_case").when(~pred.isin(*vocab.DECISIONS), "invalid_or_blank").when(truth == pred, "correct").when((truth == "DENIED") & (pred == "APPROVED"), "catastrophic_false_approval")
        .when(pred == "NEEDS_REVIEW", "conservative_review").when(truth == "NEEDS_REVIEW", "missed_review").otherwise("wrong_decision")
    )
    sums = lambda name: F.aggregate("field_results", F.lit(0).cast("bigint"), lambda a, r: a + r[name])
    c = pairs.withColumn("field_results", results)
    return c.select(
        "case_id", "present", truth.alias("truth_adjudication"), F.when(here, pred).otherwise("MISSING").alias("pred_adjudication"), "field_results",
        sums("points").alias("extraction_raw"), sums("max_points").alias("extraction_max_raw"), F.when(here, class_points(truth, pred)).otherwise(0).alias("classification_raw"), F.lit(vocab.CLASS_RAW).alias("classification_max_raw"), reason.alias("classification_reason"),
        F.when(here, pred.isin(*vocab.DECISIONS)).alias("adjudication_valid"), (here & (truth == "DENIED") & (pred == "APPROVED")).alias("catastrophic_false_approval"),
        F.when(here, sure["value"]).alias("confidence"), F.when(here, sure["valid"]).alias("confidence_valid"), F.when(here & sure["valid"], F.pow(sure["value"] - right, 2)).when(here, 1.0).alias("confidence_brier"),
        F.when(here, F.trim(F.coalesce("pred_fee_status", F.lit(""))).isin(*vocab.FEE_STATUSES)).alias("fee_status_valid"), (F.size(flag_set(F.col("traps"))) > 0).alias("traps_present"),
    )


def _field_result(name: str, weight: int, lost: Column) -> Column:
    """Struct of field, status, points, max_points: what cannot be recovered shrinks the maximum, a missing case keeps it."""
    key = flags_key if name == "risk_flags" else folded
    gone = F.array_contains(lost, name)
    hit = F.col("present") & (key(F.col(f"truth_{name}")) == key(F.col(f"pred_{name}")))
    return F.struct(
        F.lit(name).alias("field"), F.when(gone, "not_scorable_unrecoverable").when(hit, "matched").otherwise("missed").alias("status"),
        F.when(hit & ~gone, weight).otherwise(0).alias("points"), F.when(gone, 0).otherwise(weight).alias("max_points"),
    )


def samples(rows: DataFrame, keys: list[str], value: str, most: int) -> DataFrame:
    """Per group how many values there are, and the first of them in order: a report, not a cut."""
    return rows.groupBy(*keys).agg(F.count(value).alias("n"), F.slice(F.array_sort(F.collect_set(value)), 1, most).alias("first"))


def confusion(scored: DataFrame) -> DataFrame:
    """Counts by (truth, predicted or MISSING)."""
    return scored.groupBy("truth", F.coalesce("pred", F.lit("MISSING")).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def brier(scored: DataFrame) -> DataFrame:
    """Mean Brier over the rows that have a prediction, and the calibration points."""
    term = F.pow(F.col("confidence") - F.when(F.col("truth") == F.col("pred"), 1.0).otherwise(0.0), 2)
    mean = F.avg(F.when(F.col("pred").isNotNull(), term))
    points = F.lit(float(vocab.CALIBRATION_POINTS)) * F.greatest(F.lit(0.0), 1 - 2 * mean)
    return scored.agg(mean.alias("mean_brier"), F.coalesce(points, F.lit(0.0)).alias("calibration"))


def sections(scored: DataFrame) -> DataFrame:
    """Class section score, missing count and penalty; a missing case keeps its denominator."""
    raw = F.sum(F.when(F.col("pred").isNull(), 0).otherwise(class_points(F.col("truth"), F.col("pred"))))
    most = F.count(F.lit(1)) * vocab.CLASS_RAW
    missing = F.count_if(F.col("pred").isNull())
    return scored.agg(
        F.count(F.lit(1)).alias("cases"), raw.cast("bigint").alias("raw_points"), most.alias("most_points"), missing.alias("missing"),
        (vocab.CLASS_POINTS * F.coalesce(F.try_divide(raw, most), F.lit(0.0))).alias("class_score"),
        F.least(F.lit(float(vocab.MISSING_CAP)), F.lit(float(vocab.MISSING_CAP)) * F.coalesce(F.try_divide(missing, F.count(F.lit(1))), F.lit(0.0))).alias("missing_penalty"),
    )


def row_errors(columns: dict[str, Column]) -> Column:
    """All messages of a prediction row, sorted and joined; empty if the row is valid."""
    c = columns
    confidence = c["confidence"].try_cast("double")
    tests = [
        (~F.coalesce(c["case_id"].rlike(r"^MIB-[0-9]{6}$"), F.lit(False)), "case_id"),
        (~F.coalesce(c["sponsor_id"].rlike(r"^SPN-[0-9]{4}$"), F.lit(False)), "sponsor_id"),
        (strict_date(c["arrival_date"]).isNull(), "arrival_date"),
        (~F.coalesce(c["fee_status"].isin(*vocab.FEE_STATUSES), F.lit(False)), "fee_status"),
        (~F.coalesce(c["adjudication"].isin(*vocab.DECISIONS), F.lit(False)), "adjudication"),
        (~F.coalesce(confidence.between(0, 1) & ~F.isnan(confidence), F.lit(False)), "confidence"),
    ]
    return F.array_join(F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in tests])), ",")


def field_scores(pairs: DataFrame, fields: dict[str, int] = vocab.FIELD_WEIGHTS) -> DataFrame:
    """One row per (case, scorable field): status, points, max_points.

    ``pairs`` has truth_<field>, pred_<field>, present and an array ``unrecoverable``.
    Fields that cannot be recovered shrink the maximum; a missing case keeps it.
    """
    lost = F.coalesce("unrecoverable", F.array().cast("array<string>"))
    rows = pairs.select("case_id", F.explode(F.array(*[_field_result(n, w, lost) for n, w in fields.items()])).alias("f"))
    return rows.select("case_id", "f.*")


def extraction_score(scores: DataFrame) -> DataFrame:
    """Points over the attainable points, on the section's scale."""
    return scores.agg(F.sum("points").alias("raw"), F.sum("max_points").alias("most"), (vocab.EXTRACTION_POINTS * F.coalesce(F.try_divide(F.sum("points"), F.sum("max_points")), F.lit(0.0))).alias("score"))


def result_document(confusion_: DataFrame, sections_: DataFrame, brier_: DataFrame) -> DataFrame:
    """The evaluation as one row with nested counts; each input is a handful of rows."""
    counts = confusion_.agg(F.array_sort(F.collect_list(F.struct("truth", "pred", "n"))).alias("confusion"))
    return sections_.crossJoin(F.broadcast(brier_)).crossJoin(F.broadcast(counts)).withColumn("total_score", F.col("class_score") + F.col("calibration") - F.col("missing_penalty"))
