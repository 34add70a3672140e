"""Observations and their resolution to one value per (case, field).

An observation is (case_id, page_number, seq, document_type, text_source, field,
normalized_value). Groups are folded in (page_number, seq) order inside Spark: an
observation joins the first cluster whose first member it matches, clusters are
ranked by trust, and an ordered set of outcomes names value, status and method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import vocab
from ..functions.text import folded, literal_map

_OBS = "struct<page_number:int,seq:bigint,value:string,folded:string,document_type:string,text_source:string,tier:int,source:int>"
SHAPES = {"case_id": r"^MIB-\d{6}$", "sponsor_id": r"^SPN-\d{4}$"}


def exploded(pages: DataFrame, fields: str = "fields") -> DataFrame:
    """One observation per entry of each page's field map, under the canonical field name."""
    keep = [c for c in pages.columns if c != fields]
    rows = pages.select(*keep, F.explode(fields).alias("_key", "raw_value"))
    return rows.withColumn("field", F.coalesce(F.try_element_at(literal_map(vocab.ALIASES), F.col("_key")), F.col("_key"))).drop("_key")


def document_tier(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(vocab.DOCUMENT_TIERS), kind), F.lit(vocab.DEFAULT_TIER))


def source_tier(source: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(vocab.SOURCE_TIERS), source), F.lit(1))


def _prefixed(native: Column, ocr: Column) -> Column:
    tail = F.substr(ocr, F.length(native) + 1)
    return (native != "") & (ocr != "") & F.startswith(ocr, native) & (F.length(F.regexp_replace(F.lower(tail), "[^a-z0-9]+", "")) <= 3)


def matches(a: Column, b: Column) -> Column:
    """Equal after folding, or a native reading that the OCR reading extends by noise only."""
    return (
        (a["folded"] == b["folded"])
        | (a["text_source"] == "native_text") & (b["text_source"] == "ocr") & _prefixed(a["folded"], b["folded"])
        | (a["text_source"] == "ocr") & (b["text_source"] == "native_text") & _prefixed(b["folded"], a["folded"])
    )


def clusters(observations: Column) -> Column:
    """Greedy, in order: an array of arrays."""
    start = F.array().cast(f"array<array<{_OBS}>>")

    def place(acc: Column, o: Column) -> Column:
        hits = F.transform(acc, lambda c: matches(F.get(c, 0), o))
        at = F.array_position(hits, True)
        joined = F.transform(acc, lambda c, i: F.when(i + 1 == at, F.array_append(c, o)).otherwise(c))
        return F.when(at > 0, joined).otherwise(F.array_append(acc, F.array(o)))

    return F.aggregate(observations, start, place)


def resolved(observations: DataFrame) -> DataFrame:
    """(case_id, field, resolved_value, status, resolution_method) for every group of a known case; readings that are not trusted do not count."""
    one = F.struct(
        F.col("page_number").cast("int").alias("page_number"), F.col("seq").cast("bigint").alias("seq"), F.col("normalized_value").alias("value"), folded(F.col("normalized_value")).alias("folded"),
        "document_type", "text_source", document_tier(F.col("document_type")).alias("tier"), source_tier(F.col("text_source")).alias("source"),
    )
    counts = F.col("normalized_value").isNotNull()
    if "trusted" in observations.columns:
        counts = counts & F.coalesce(F.col("trusted"), F.lit(False))
    groups = observations.where(F.col("case_id").isNotNull()).groupBy("case_id", "field").agg(F.array_sort(F.collect_list(F.when(counts, one))).alias("obs"))
    groups = groups.withColumn("clusters", clusters(F.col("obs")))
    ranked = F.array_sort(F.transform("clusters", lambda c, i: F.struct(
        F.array_min(F.transform(c, lambda o: o["tier"])).alias("tier"),
        (-F.size(F.array_distinct(F.transform(c, lambda o: o["document_type"])))).alias("types"),
        (-F.array_max(F.transform(c, lambda o: o["source"]))).alias("source"),
        i.alias("at"),
        F.element_at(F.array_sort(F.transform(c, lambda o, j: F.struct((-o["source"]).alias("s"), j.alias("j"), o["value"].alias("v")))), 1)["v"].alias("value"),
        F.exists(c, lambda o: o["text_source"] == "native_text").alias("native"),
        F.exists(c, lambda o: o["text_source"] == "ocr").alias("ocr"),
        F.size(c).alias("size"),
        F.size(F.array_distinct(F.transform(c, lambda o: o["folded"]))).alias("spellings"),
    )))
    groups = groups.withColumn("r", ranked)
    shape = F.try_element_at(literal_map(SHAPES), F.col("field"))
    top, second = F.get("r", 0), F.get("r", 1)
    shaped = F.filter("r", lambda c: F.regexp_like(c["value"], F.coalesce(shape, F.lit(".*"))))
    rescue = F.when(shape.isNotNull() & ~F.regexp_like(top["value"], F.coalesce(shape, F.lit(".*"))) & (F.size(shaped) > 0), F.get(shaped, 0))
    natives = F.filter("r", lambda c: c["native"])
    native = F.when((F.col("field") == "applicant_name") & ~top["native"] & (F.size(natives) > 0), F.get(natives, 0))
    support = lambda c: F.when(c["types"] < -1, "corroborated").otherwise("single_source")
    out = (
        F.when(F.size("r") == 0, _outcome(F.lit(None).cast("string"), F.lit("missing"), F.lit("no_usable_observation")))
        .when(rescue.isNotNull(), _outcome(rescue["value"], support(rescue), F.lit("shape_valid_preferred_over_malformed")))
        .when(native.isNotNull(), _outcome(native["value"], support(native), F.lit("native_preferred_over_ocr")))
        .when((F.size("r") > 1) & (top["tier"] >= second["tier"]), _outcome(F.lit(None).cast("string"), F.lit("conflicting"), F.lit("equal_priority_conflict")))
        .when(F.size("r") > 1, _outcome(top["value"], F.lit("resolved_by_evidence_priority"), F.lit("evidence_priority")))
        .otherwise(_outcome(top["value"], support(top), F.when(top["size"] == 1, "single_observation").when(top["spellings"] == 1, "exact_match").when(top["native"] & top["ocr"], "native_ocr_match").otherwise("source_aware_match")))
    )
    return groups.select("case_id", "field", out.alias("o")).select("case_id", "field", "o.*")


def _outcome(value: Column, status: Column, method: Column) -> Column:
    return F.struct(value.alias("resolved_value"), status.alias("status"), method.alias("resolution_method"))


def resolved_exact(observations: DataFrame) -> DataFrame:
    """Resolution where only equal values agree: two aggregations and a window, no fold."""
    o = observations.where("normalized_value IS NOT NULL AND case_id IS NOT NULL").withColumn("folded", folded(F.col("normalized_value"))).withColumn("tier", document_tier(F.col("document_type"))).withColumn("source", source_tier(F.col("text_source")))
    c = o.groupBy("case_id", "field", "folded").agg(
        F.min("tier").alias("tier"), F.countDistinct("document_type").alias("types"), F.max("source").alias("source"),
        F.min(F.struct("page_number", "seq")).alias("first"), F.min_by("normalized_value", F.struct(-F.col("source"), "page_number", "seq")).alias("value"),
    )
    w = W.partitionBy("case_id", "field").orderBy("tier", F.desc("types"), F.desc("source"), "first")
    c = c.withColumn("n", F.row_number().over(w)).withColumn("next_tier", F.lead("tier").over(w)).where("n = 1")
    conflict = F.col("tier") >= F.col("next_tier")
    status = F.when(conflict, "conflicting").when(F.col("next_tier").isNotNull(), "resolved_by_evidence_priority").when(F.col("types") > 1, "corroborated").otherwise("single_source")
    return c.select("case_id", "field", F.when(F.coalesce(conflict, F.lit(False)), None).otherwise(F.col("value")).alias("resolved_value"), status.alias("status"))


def wide(resolved_: DataFrame, fields: list[str]) -> DataFrame:
    """One row per case: the value and status of each field."""
    return resolved_.groupBy("case_id").pivot("field", fields).agg(F.first("resolved_value").alias("value"), F.first("status").alias("status"))
