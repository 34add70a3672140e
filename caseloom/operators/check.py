"""Checks of rows against fixed formats: prediction rows, manual labels, selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import given, strict_date, stripped
from ..sources.readers import PREDICTION_COLUMNS

FIELDS = (*PREDICTION_COLUMNS, "confidence")


def row_messages(row: Column, kinds: Column | None = None, written_as: str = "json") -> Column:
    """Every message about a prediction row, in order; empty for a valid row.

    ``row`` is a map of field to written value, null where the value is null.
    ``kinds`` maps a field to its JSON type ("string", "number", "boolean", "null");
    without it every value counts as a string, as in a CSV file. Missing fields end
    the checks of a row.
    """
    names = F.array(*[F.lit(f) for f in FIELDS])
    absent, extra = F.array_except(names, F.map_keys(row)), F.array_sort(F.array_except(F.map_keys(row), names))
    listed = lambda what, a: F.when(F.size(a) > 0, F.concat(F.lit(what + ": "), F.array_join(a, ",")))
    kind = (lambda f: F.coalesce(F.try_element_at(kinds, F.lit(f)), F.lit("null"))) if kinds is not None else (lambda f: F.lit("string"))
    text = lambda f: F.when(kind(f) == "string", F.coalesce(stripped(F.try_element_at(row, F.lit(f))), F.lit(""))).otherwise("")
    said = lambda f: F.coalesce(F.try_element_at(row, F.lit(f)), F.lit("null"))
    bad = lambda f, test: F.when(test, F.concat(F.lit(f"invalid {f}: "), said(f)))
    number = F.try_element_at(row, F.lit("confidence")).try_cast("double")
    range_ = F.when(number.isNull(), "confidence is not numeric").when(~(number.between(0, 1) & ~F.isnan(number)), "confidence out of range")
    if written_as == "json":
        range_ = F.when(kind("confidence") != "number", "confidence is no number").otherwise(range_)
    rest = F.array(
        *[F.when(kind(f) != "string", f"{f} is no string") for f in FIELDS[:-1]],
        bad("case_id", ~text("case_id").rlike(r"^MIB-[0-9]{6}$")), bad("sponsor_id", ~text("sponsor_id").rlike(r"^SPN-[0-9]{4}$")), bad("arrival_date", strict_date(text("arrival_date")).isNull()),
        bad("fee_status", (kind("fee_status") == "string") & ~text("fee_status").isin(*vocab.FEE_STATUSES)), bad("adjudication", (kind("adjudication") == "string") & ~text("adjudication").isin(*vocab.DECISIONS)), range_,
    )
    head = F.array(listed("missing", absent), listed("unexpected", extra))
    return F.array_compact(F.when(F.size(absent) > 0, head).otherwise(F.concat(head, rest)))


# What a reviewer may enter; empty is allowed.
MANUAL = {
    "root_cause": ("", "ocr_characters", "ocr_layout", "regex", "classification", "orientation", "case_assignment", "corroboration", "evidence_precedence", "policy", "visual_evidence", "unrecoverable", "possible_label_issue", "pipeline_error", "other"),
    "recoverable": ("", "yes", "probably", "no"), "fix_priority": ("", "now", "later", "do_not_fix"),
}


def unknown_labels(rows: DataFrame, allowed: dict[str, tuple[str, ...]] = MANUAL) -> DataFrame:
    """(case_id, field, label, value) of every manual label that is not on its list."""
    found = F.array(*[F.struct(F.lit(c).alias("label"), F.coalesce(F.trim(F.col(c)), F.lit("")).alias("value"), F.coalesce(F.trim(F.col(c)), F.lit("")).isin(*values).alias("ok")) for c, values in allowed.items()])
    return rows.select("case_id", "field", F.inline(found)).where("NOT ok").drop("ok")


def with_known_labels(rows: DataFrame, allowed: dict[str, tuple[str, ...]] = MANUAL) -> DataFrame:
    """The rows; reading one with a label that is not on its list fails."""
    fine = F.lit(True)
    for c, values in allowed.items():
        fine = fine & F.coalesce(F.trim(F.col(c)), F.lit("")).isin(*values)
    return rows.where(F.when(fine, True).otherwise(F.raise_error(F.concat(F.lit("a label that is not on its list: "), F.coalesce(F.col("case_id"), F.lit("")), F.lit(" "), F.coalesce(F.col("field"), F.lit("")))).cast("boolean")))


def selected(rows: DataFrame, case_id: str | None = None, fields: str | None = None, limit: int | None = None, order: str = "path") -> DataFrame:
    """One case, a comma-separated list of fields, the first rows of an order: each only if given."""
    if case_id is not None:
        rows = rows.where(F.col("case_id") == case_id)
    if fields is not None:
        rows = rows.where(F.col("field").isin(*[f.strip() for f in fields.split(",") if f.strip()]))
    return rows.orderBy(order).limit(limit) if limit is not None else rows


def flag(value: Column) -> Column:
    """A written truth value; anything else is false."""
    return F.coalesce(F.lower(stripped(value.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def whole(value: Column, default: int = 0) -> Column:
    """A written number cut to an integer; the default if there is none."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), F.lit(default)).otherwise(number.cast("bigint"))


def compared(field: Column, value: Column) -> Column:
    """A value as errors are counted by: stripped, empty as null, flags distinct and sorted."""
    v = given(value)
    flags = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(v, r"\|"), lambda p: stripped(p)), lambda p: p != "")))
    return F.when(field == "risk_flags", F.nullif(F.array_join(flags, "|"), F.lit(""))).otherwise(v)


def error_rows(expected: DataFrame, resolved: DataFrame, observations: DataFrame | None = None) -> DataFrame:
    """One row per (case, field) whose resolved value is not the label's, with its category and observations as JSON.

    ``expected`` is (case_id, field, value), one row per label and field; ``resolved``
    (case_id, field, resolved_value, status, resolution_method); ``observations``
    (case_id, field, page_number, document_type, text_source, raw_value, normalized_value).
    """
    from .triage import error_category

    f = F.col("field")
    rows = expected.select("case_id", "field", compared(f, F.col("value")).alias("expected_value")).join(resolved.select("case_id", "field", compared(f, F.col("resolved_value")).alias("predicted_value"), F.col("status").alias("_status"), "resolution_method"), ["case_id", "field"], "left")
    rows = rows.where(~F.col("expected_value").eqNullSafe(F.col("predicted_value")))
    rows = rows.withColumn("error_category", error_category(F.col("expected_value"), F.col("predicted_value"), F.col("_status"))).withColumn("resolution_status", F.coalesce("_status", F.lit("field_absent"))).drop("_status")
    if observations is not None:
        one = F.struct(F.col("page_number").alias("page"), "document_type", "text_source", "raw_value", "normalized_value")
        rows = rows.join(observations.groupBy("case_id", "field").agg(F.array_sort(F.collect_list(one)).alias("_seen")), ["case_id", "field"], "left")
        rows = rows.withColumn("all_observations", F.to_json(F.coalesce("_seen", F.array().cast(rows.schema["_seen"].dataType)), {"ignoreNullFields": "false"})).drop("_seen")
    return rows
