"""The review queue: error rows, priorities, ranks, summaries, cross tables, word lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import vocab
from ..functions.text import literal_map


def error_category(expected: Column, predicted: Column, status: Column) -> Column:
    return (
        F.when(status.isNull(), "field_not_extracted").when(status == "missing", "missing_value").when(status == "conflicting", "corroboration_conflict")
        .when(predicted.isNull(), "normalization_returned_none").when(expected.isNull(), "unexpected_prediction").otherwise("incorrect_value")
    )


def priority(field: Column, category: Column, status: Column, unassigned_pages: Column, unassigned: Column) -> Column:
    weight = F.coalesce(F.try_element_at(literal_map(vocab.FIELD_WEIGHTS), field), F.lit(1)).cast("double")
    bonus = F.coalesce(F.try_element_at(literal_map(vocab.CATEGORY_BONUS), category), F.lit(0.0))
    flag = lambda test, x: F.when(test, x).otherwise(0.0)
    conflict = status.eqNullSafe("conflicting")
    return (
        weight + bonus + flag(conflict, 2.0) + flag(F.coalesce(F.trim(unassigned_pages), F.lit("")) != "", 3.0) + F.least(F.greatest(F.coalesce(unassigned, F.lit(0)), F.lit(0)), F.lit(5)) * 0.5
        + flag(field == "risk_flags", 4.0) + flag((field == "applicant_name") & conflict, 2.0)
    )


def queue(rows: DataFrame, top: int) -> DataFrame:
    """The first rows by priority, case and field, ranked; the sort is a top-k, the rank follows it."""
    first = rows.orderBy(F.desc("priority"), "case_id", "field").limit(top)
    return first.withColumn("review_rank", F.row_number().over(W.orderBy(F.desc("priority"), "case_id", "field")))


def case_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("errors"), F.max("priority").alias("top_priority"), F.sum("weight").alias("weighted"),
        F.array_join(F.array_sort(F.collect_set("field")), "|").alias("fields"), F.array_join(F.array_sort(F.collect_set("category")), "|").alias("categories"), F.bool_and("reviewed").alias("all_reviewed"),
    )


def root_causes(rows: DataFrame) -> DataFrame:
    """Counts and shares per category; the total is one row, joined to a handful."""
    per = rows.groupBy("category").agg(F.count(F.lit(1)).alias("errors"), F.sum("weight").alias("weighted"))
    return per.withColumn("share", F.col("errors") / F.sum("errors").over(W.partitionBy()))


def label_summary(rows: DataFrame, label: str) -> DataFrame:
    """Reviewed errors by a label: counts and weights with their percentages to two places, most frequent first."""
    per = rows.where(F.coalesce(F.trim(F.col(label)), F.lit("")) != "").groupBy(label).agg(F.count(F.lit(1)).alias("errors"), F.sum("weight").cast("bigint").alias("weighted"))
    whole = W.partitionBy()  # over a handful of labels
    percent = lambda c: F.round(F.coalesce(F.try_divide(F.col(c) * 100.0, F.sum(c).over(whole)), F.lit(0.0)), 2)
    return per.withColumn("errors_percent", percent("errors")).withColumn("weighted_percent", percent("weighted")).orderBy(F.desc("errors"), label)


def by_urgency(summary: DataFrame) -> DataFrame:
    """Case summaries, the most urgent first."""
    return summary.orderBy(F.desc("top_priority"), F.desc("weighted"), "case_id")


def flag_rows(rows: DataFrame, flags: str = "risk_flags") -> DataFrame:
    """One row per (row, flag) of a list with bars; none is no flag."""
    return rows.withColumn(flags, F.explode(F.split(flags, r"\|"))).withColumn(flags, F.trim(flags)).where(F.col(flags) != "none")


def crosstab(rows: DataFrame, down: str, across: str, values: list) -> DataFrame:
    """Counts of one column's values by another's, 0 where there are none."""
    return rows.groupBy(down).pivot(across, values).agg(F.count(F.lit(1))).na.fill(0)


def flag_combinations(exploded: DataFrame, among: tuple[str, ...], decision: str = "adjudication") -> DataFrame:
    """Sets of two or more of these flags that cases have, with the number of cases by decision."""
    sets = exploded.where(F.col("risk_flags").isin(*among)).groupBy("case_id").agg(F.array_sort(F.collect_set("risk_flags")).alias("s")).where(F.size("s") >= 2)
    cases = exploded.groupBy("case_id").agg(F.min(decision).alias(decision))
    return crosstab(sets.join(cases, "case_id").withColumn("combination", F.array_join("s", "|")), "combination", decision, list(vocab.DECISIONS))


def lines_by_top(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Per page its lines from top to bottom."""
    return lines.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("top", "left", "text"))), lambda x: x["text"]).alias("lines"))


def word_lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """OCR words to lines: text, box, mean of the confidences that are not negative."""
    return words.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_no", "text"))), lambda w: w["text"]), " ").alias("text"),
        F.min("left").alias("left"), F.min("top").alias("top"), F.max("right").alias("right"), F.max("bottom").alias("bottom"), F.avg(F.when(F.col("conf") >= 0, F.col("conf"))).alias("conf"),
    )


def islands(rows: DataFrame, keys: list[str], order: str, test: Column, least: int) -> DataFrame:
    """Runs of consecutive rows that pass a test, of at least this many rows."""
    w = W.partitionBy(*keys).orderBy(order)
    marked = rows.withColumn("_n", F.row_number().over(w)).withColumn("_ok", test).where("_ok")
    marked = marked.withColumn("_g", F.col("_n") - F.row_number().over(w))
    return marked.groupBy(*keys, "_g").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).drop("_g")
