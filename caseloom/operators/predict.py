"""Pages to predictions: classify, extract, normalize, resolve, derive, decide, render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize, vocab
from ..functions.stored import checkpointed
from ..functions.text import given, strict_date, stripped
from . import derive, labelled, observe, pages, resolve

FIELDS = ["applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "risk_flags", "fee_status", "registry_status", "amount", "waiver_code", "adjudicator_decision", "adjudicator_reason"]


def observations(page_texts: DataFrame) -> DataFrame:
    """(case_id, page_number, text, text_source) to normalized observations."""
    text = F.col("text")
    p = page_texts.withColumn("document_type", pages.classified(text)["document_type"]).withColumn("notes", pages.corrections(text))
    p = p.withColumn("text", pages.without_corrections(text)).withColumn("found", pages.extracted(F.col("document_type"), pages.without_corrections(text)))
    p = labelled.completed(p)
    p = p.withColumn("fields", F.map_concat(F.map_filter("found", lambda k, v: ~F.map_contains_key(F.col("notes"), k)), F.col("notes")))
    p = p.withColumn("seq", F.col("page_number").cast("bigint"))
    # Read for the values to match, the resolution and the names.
    o = resolve.exploded(checkpointed(p.select("case_id", "page_number", "seq", "document_type", "text_source", "fields")))
    return normalize.normalized(o.where("field <> 'case_id'"))


def name_outliers(observed: DataFrame) -> DataFrame:
    """(case_id, flag): a native name on a suspect document that no third document confirms.

    What is no name (``observe.plausible_name``) is no evidence on either side. Exact agreement is found by a join of the sets; only what is left is compared by
    matching blocks, per distinct pair of names.
    """
    from ..functions.similarity import ratio_udf

    names = observed.where("field = 'applicant_name' AND normalized_value IS NOT NULL").select("case_id", "document_type", "text_source", stripped(F.col("normalized_value")).alias("name")).where(observe.plausible_name(F.col("name")))
    flag = F.when(F.col("document_type") == "intake_form", "identity_conflict").otherwise("sponsor_mismatch")
    suspect = names.where("text_source = 'native_text' AND document_type IN ('intake_form', 'sponsor_attestation')").select("case_id", flag.alias("flag"), "name").distinct()
    third = names.where("document_type NOT IN ('intake_form', 'sponsor_attestation')").select("case_id", F.col("name").alias("other")).distinct()
    met = suspect.join(third, "case_id")
    clear = met.groupBy("case_id", "flag").agg(F.max((F.col("name") == F.col("other")).cast("int")).alias("same")).where("same = 0").drop("same")
    left = met.join(clear, ["case_id", "flag"])
    near = left.withColumn("ratio", ratio_udf(F.lower("name"), F.lower("other"))).groupBy("case_id", "flag").agg(F.max("ratio").alias("ratio"))
    return near.where("ratio < 0.70").select("case_id", "flag")


def _value(c: str) -> Column:
    return F.col(f"{c}_value")


#: Rules that read a flag off a case's resolved fields, each a Column that is null where it does not apply; callers may add their own.
DERIVATIONS = {
    "registry_status": lambda: F.when(F.upper(_value("registry_status")).contains("EMBARGO"), "planetary_embargo"),
    "adjudicator_reason": lambda: derive.reason_flag(_value("adjudicator_reason")),
}


def decided(resolved_wide: DataFrame, outliers: DataFrame | None = None, derivations: dict = DERIVATIONS) -> DataFrame:
    """Derived fee and flags, and the decision, on one row per case."""
    w = resolved_wide
    if outliers is not None:
        w = w.join(outliers.groupBy("case_id").agg(F.collect_set("flag").alias("_outliers")), "case_id", "left")
    else:
        w = w.withColumn("_outliers", F.lit(None).cast("array<string>"))
    derived = F.array_union(F.coalesce("_outliers", F.array().cast("array<string>")), F.array_compact(F.array(*[rule() for rule in derivations.values()])))
    flags = derive.merged_flags(F.split(_value("risk_flags"), r"\|"), derived)
    fee = F.coalesce(derive.fee_from_amount(normalize.amount(_value("amount")), derive.waiver_class(_value("waiver_code"))), _value("fee_status"))
    conflict = F.lit(False)
    for c in ("visa_class", "arrival_date"):
        conflict = conflict | F.coalesce(F.col(f"{c}_status") == "conflicting", F.lit(False))
    w = w.withColumn("flags", flags).withColumn("fee", fee)
    made = derive.adjudicated(_value("adjudicator_decision"), _value("visa_class"), _value("arrival_date"), F.split("flags", r"\|"), F.col("fee"), _value("sponsor_id"), conflict)
    return w.withColumn("decision", made)


def rendered(d: DataFrame) -> DataFrame:
    """Prediction rows: placeholders where a value does not fit its pattern."""
    text = lambda c: F.coalesce(given(_value(c)), F.lit("")).alias(c)
    sponsor, arrival = _value("sponsor_id"), _value("arrival_date")
    return d.select(
        "case_id", *[text(c) for c in ("applicant_name", "species_code", "home_world", "visa_class")],
        F.when(sponsor.rlike(r"^SPN-\d{4}$"), sponsor).otherwise("SPN-0000").alias("sponsor_id"), F.when(strict_date(arrival).isNotNull(), arrival).otherwise("1970-01-01").alias("arrival_date"), text("declared_purpose"),
        F.coalesce("flags", F.lit("none")).alias("risk_flags"), F.when(F.col("fee").isin(*vocab.FEE_STATUSES), F.col("fee")).otherwise("unknown").alias("fee_status"),
        F.col("decision.decision").alias("adjudication"), F.round(F.col("decision.confidence").cast("double"), 4).alias("confidence"),
    )


def predicted(page_texts: DataFrame, packets: DataFrame | None = None) -> DataFrame:
    """One prediction per case; packets without any observation get the cautious one."""
    o = observations(page_texts)
    out = rendered(decided(resolve.wide(resolve.resolved(o), FIELDS), name_outliers(o)))
    if packets is None:
        return out
    from ..sources.writers import baseline

    rest = packets.select("case_id").distinct().join(out, "case_id", "left_anti")
    return out.unionByName(baseline(rest))
