"""The case model over the driver's tables, by plain rules that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

KINDS = ("unknown", "adjudicator_note", "intake_form", "fee_receipt", "biometric_slip", "sponsor_attestation", "registry_extract")
VISA_WRITTEN = ("xw1", "XW-2", "med 3", "DIP1", "TRANS1T-7")


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(index: Column, values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as observations of four fields, by page and document kind."""
    li = t(spark, sf, "lineitem")
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    base = li.select(
        F.concat(F.lit("MIB-"), F.lpad(F.col("l_orderkey").cast("string"), 6, "0")).alias("case_id"), F.col("l_linenumber").alias("page_number"), F.row_number().over(w).cast("bigint").alias("seq"),
        pick(F.col("l_linenumber") % 7, KINDS).alias("document_type"), F.when(F.col("l_returnflag") == "A", "native_text").when(F.col("l_returnflag") == "R", "ocr").otherwise("none").alias("text_source"),
        F.create_map(
            F.lit("sponsor_id"), F.concat(F.lit("spn "), F.lpad((F.col("l_suppkey") % 50).cast("string"), 4, "0")),
            F.lit("visa_class"), pick(F.col("l_partkey") % 5, VISA_WRITTEN),
            F.lit("arrival_date"), F.date_format("l_shipdate", "yyyy/MM/dd"),
            F.lit("fee_status"), F.when(F.col("l_tax") > 0.04, " PA1D ").when(F.col("l_tax") > 0.02, "unpaid").otherwise("waived"),
        ).alias("fields"),
    )
    return base


OBSERVATIONS_SQL = """
base AS (
  SELECT 'MIB-' || lpad(CAST(l_orderkey AS VARCHAR), 6, '0') AS case_id, l_linenumber AS page_number,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS seq,
    ['unknown', 'adjudicator_note', 'intake_form', 'fee_receipt', 'biometric_slip', 'sponsor_attestation', 'registry_extract'][l_linenumber % 7 + 1] AS document_type,
    CASE l_returnflag WHEN 'A' THEN 'native_text' WHEN 'R' THEN 'ocr' ELSE 'none' END AS text_source,
    'SPN-' || lpad(CAST(l_suppkey % 50 AS VARCHAR), 4, '0') AS sponsor_id,
    ['XW-1', 'XW-2', 'MED-3', 'DIP-1', 'TRANSIT-7'][l_partkey % 5 + 1] AS visa_class,
    strftime(l_shipdate, '%Y-%m-%d') AS arrival_date,
    CASE WHEN l_tax > 0.04 THEN 'paid' WHEN l_tax > 0.02 THEN 'unpaid' ELSE 'waived' END AS fee_status
  FROM lineitem
), obs AS (
  UNPIVOT base ON sponsor_id, visa_class, arrival_date, fee_status INTO NAME field VALUE normalized_value
), tiered AS (
  SELECT *, CASE document_type WHEN 'adjudicator_note' THEN 1 WHEN 'intake_form' THEN 2 WHEN 'fee_receipt' THEN 2 WHEN 'biometric_slip' THEN 3
      WHEN 'sponsor_attestation' THEN 4 WHEN 'registry_extract' THEN 5 ELSE 6 END AS tier,
    CASE text_source WHEN 'native_text' THEN 3 WHEN 'ocr' THEN 2 ELSE 1 END AS source
  FROM obs
)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as truth; a prediction by a rule over the documents, missing where a document has under 300 characters to tell from."""
    d = t(spark, sf, "documents").where("n_chars >= 300").select("doc_id", F.when(F.col("n_chars") > 1500, "APPROVED").when(F.col("n_chars") > 400, "NEEDS_REVIEW").otherwise("DENIED").alias("pred"), ((F.col("doc_id") % 100) / 100.0).alias("confidence"))
    truth = F.when(F.col("toxic") == 1, "DENIED").when(F.col("quality") == 1, "APPROVED").otherwise("NEEDS_REVIEW")
    return t(spark, sf, "labels").select("doc_id", truth.alias("truth")).join(d, "doc_id", "left")


SCORED_SQL = """
scored AS (
  SELECT l.doc_id, CASE WHEN toxic = 1 THEN 'DENIED' WHEN quality = 1 THEN 'APPROVED' ELSE 'NEEDS_REVIEW' END AS truth,
    d.pred, d.confidence
  FROM labels l LEFT JOIN (
    SELECT doc_id, CASE WHEN n_chars > 1500 THEN 'APPROVED' WHEN n_chars > 400 THEN 'NEEDS_REVIEW' ELSE 'DENIED' END AS pred,
      CAST(doc_id % 100 AS DOUBLE) / 100.0 AS confidence
    FROM documents WHERE n_chars >= 300) d USING (doc_id)
)"""


def wide_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as wide, resolved cases."""
    o = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("MIB-"), F.lpad(k.cast("string"), 6, "0")).alias("case_id"), F.when(k % 97 == 0, "finding: none").when(k % 53 == 0, "review").alias("note"),
        pick(k % 6, ("XW-1", "XW-2", "MED-3", "DIP-1", "TRANSIT-7", None)).alias("visa_class"), F.date_format(F.date_add(F.lit("2026-07-12").cast("date"), -(k % 250).cast("int")), "yyyy-MM-dd").alias("arrival_date"),
        pick(k % 11, ("none", "none", "none", "biohazard_red", "none", "identity_conflict", "none", "none", "none", "none", "none")).alias("flag"), pick(k % 5, ("paid", "waived", "unpaid", "unknown", None)).alias("fee_status"),
        F.when(k % 13 == 0, None).when(k % 17 == 0, "SPN-4040").otherwise(F.concat(F.lit("SPN-"), F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0"))).alias("sponsor_id"), (k % 29 == 0).alias("conflicting"),
    )


WIDE_SQL = """
wide AS (
  SELECT 'MIB-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS case_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN 'NEEDS_REVIEW' END AS said,
    ['XW-1', 'XW-2', 'MED-3', 'DIP-1', 'TRANSIT-7', NULL][o_orderkey % 6 + 1] AS visa,
    250 AS x, o_orderkey % 250 AS age,
    ['none', 'none', 'none', 'biohazard_red', 'none', 'identity_conflict', 'none', 'none', 'none', 'none', 'none'][o_orderkey % 11 + 1] AS flag,
    ['paid', 'waived', 'unpaid', 'unknown', NULL][o_orderkey % 5 + 1] AS fee,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'SPN-4040' ELSE 'SPN-' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS sponsor,
    o_orderkey % 29 = 0 AS conflicting
  FROM orders
)"""


def errors(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as discrepancies for the review queue."""
    li = t(spark, sf, "lineitem")
    k = F.col("l_partkey")
    field = pick(k % 9, ("applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "risk_flags", "fee_status"))
    status = pick(F.col("l_suppkey") % 4, (None, "missing", "conflicting", "single_source"))
    return li.select(
        F.concat(F.lit("MIB-"), F.lpad(F.col("l_orderkey").cast("string"), 6, "0")).alias("case_id"), field.alias("field"), status.alias("status"), F.when(F.col("l_linenumber") % 3 == 0, None).otherwise("x").alias("predicted"),
        F.when(F.col("l_linenumber") % 5 == 0, None).otherwise("y").alias("expected"), F.when(F.col("l_returnflag") == "R", "3|4").otherwise(" ").alias("unassigned_pages"), (F.col("l_quantity").cast("int") % 8).alias("unassigned"), (F.col("l_discount") > 0.05).alias("reviewed"),
    )


ERRORS_SQL = """
e0 AS (
  SELECT 'MIB-' || lpad(CAST(l_orderkey AS VARCHAR), 6, '0') AS case_id,
    ['applicant_name', 'species_code', 'home_world', 'visa_class', 'sponsor_id', 'arrival_date', 'declared_purpose', 'risk_flags', 'fee_status'][l_partkey % 9 + 1] AS field,
    [NULL, 'missing', 'conflicting', 'single_source'][l_suppkey % 4 + 1] AS status,
    l_linenumber % 3 = 0 AS no_pred, l_linenumber % 5 = 0 AS no_exp, l_returnflag = 'R' AS pages, CAST(l_quantity AS INTEGER) % 8 AS unassigned, l_discount > 0.05 AS reviewed
  FROM lineitem
), e1 AS (
  SELECT *, CASE WHEN status IS NULL THEN 'field_not_extracted' WHEN status = 'missing' THEN 'missing_value' WHEN status = 'conflicting' THEN 'corroboration_conflict'
      WHEN no_pred THEN 'normalization_returned_none' WHEN no_exp THEN 'unexpected_prediction' ELSE 'incorrect_value' END AS category,
    CASE field WHEN 'applicant_name' THEN 5 WHEN 'species_code' THEN 6 WHEN 'home_world' THEN 5 WHEN 'visa_class' THEN 5 WHEN 'sponsor_id' THEN 5
      WHEN 'arrival_date' THEN 4 WHEN 'declared_purpose' THEN 3 WHEN 'risk_flags' THEN 8 WHEN 'fee_status' THEN 4 END AS weight
  FROM e0
), err AS (
  SELECT *, CAST(weight AS DOUBLE)
    + CASE category WHEN 'field_not_extracted' THEN 5.0 WHEN 'missing_value' THEN 4.0 WHEN 'normalization_returned_none' THEN 3.5 WHEN 'corroboration_conflict' THEN 3.0
        WHEN 'incorrect_value' THEN 2.0 ELSE 1.0 END
    + CASE WHEN status = 'conflicting' THEN 2.0 ELSE 0.0 END + CASE WHEN pages THEN 3.0 ELSE 0.0 END + least(unassigned, 5) * 0.5
    + CASE WHEN field = 'risk_flags' THEN 4.0 ELSE 0.0 END + CASE WHEN field = 'applicant_name' AND status = 'conflicting' THEN 2.0 ELSE 0.0 END AS priority
  FROM e1
)"""
