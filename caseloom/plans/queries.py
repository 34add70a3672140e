"""The query catalogue: name to query, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import normalize, similarity, vocab
from ..functions.text import collapsed
from ..operators import derive, evaluate, identity, labelled, observe, pages, predict, resolve, series, triage
from ..streaming import arrivals
from .cases import ERRORS_SQL, OBSERVATIONS_SQL, SCORED_SQL, WIDE_SQL, errors, observations, pick, scored, t, wide_cases

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def _case(k: str) -> Column:
    return F.concat(F.lit("MIB-"), F.lpad(F.col(k).cast("string"), 6, "0"))


# Scans, dedupe, joins, sets ------------------------------------------------------------------


@query("scan_filter_project", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'")
def _(s: SparkSession, sf: str) -> DataFrame:
    return t(s, sf, "orders").where("o_totalprice > 100000 AND o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus", "o_totalprice")


_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate"


@query("dedupe_first_wins", f"SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) = 1")
def _(s, sf):
    return evaluate.first_wins(t(s, sf, "lineitem"), "l_orderkey", *[F.col(c) for c in _ORDER.split(", ")]).select("l_orderkey", "l_partkey", "l_suppkey")


@query("dedupe_last_wins", f"SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(c + ' DESC' for c in _ORDER.split(', '))}) = 1")
def _(s, sf):
    return evaluate.last_wins(t(s, sf, "lineitem"), "l_orderkey", *_ORDER.split(", ")).select("l_orderkey", "l_partkey", "l_suppkey")


@query("duplicate_ids", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(s, sf):
    return t(s, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("join_left_truth_pred", f"WITH {SCORED_SQL} SELECT * FROM scored")
def _(s, sf):
    return scored(s, sf)


@query("join_semi_scored", "SELECT doc_id, n_chars FROM documents SEMI JOIN labels USING (doc_id)")
def _(s, sf):
    return t(s, sf, "documents").select("doc_id", "n_chars").join(t(s, sf, "labels"), "doc_id", "left_semi")


@query("join_anti_missing", "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars >= 300)")
def _(s, sf):
    return t(s, sf, "labels").select("doc_id", "quality").join(t(s, sf, "documents").where("n_chars >= 300"), "doc_id", "left_anti")


@query("join_anti_extra", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(s, sf):
    return t(s, sf, "documents").select("doc_id").join(t(s, sf, "labels"), "doc_id", "left_anti")


@query("join_broadcast_tier", f"WITH {OBSERVATIONS_SQL} SELECT tier, source, count(*) AS n FROM tiered GROUP BY 1, 2")
def _(s, sf):
    o = resolve.exploded(observations(s, sf))
    return o.groupBy(resolve.document_tier(F.col("document_type")).alias("tier"), resolve.source_tier(F.col("text_source")).alias("source")).agg(F.count(F.lit(1)).alias("n"))


@query("join_prefix_locate", "SELECT p.p_partkey, coalesce(e.r_name, min(f.r_name)) AS r_name FROM part p LEFT JOIN region e ON upper(p.p_brand) = e.r_name LEFT JOIN region f ON starts_with(f.r_name, upper(substr(p.p_name, 1, 1))) GROUP BY p.p_partkey, e.r_name")
def _(s, sf):
    part, region = t(s, sf, "part"), t(s, sf, "region")
    exact = part.join(F.broadcast(region.select(F.col("r_name").alias("exact"))), F.upper("p_brand") == F.col("exact"), "left")
    # The other side is a handful of names; each part meets those of its first letter.
    near = region.groupBy(F.substring("r_name", 1, 1).alias("letter")).agg(F.min("r_name").alias("near"))
    found = exact.join(F.broadcast(near), F.upper(F.substring("p_name", 1, 1)) == F.col("letter"), "left")
    return found.select("p_partkey", F.coalesce("exact", "near").alias("r_name"))


@query("unpivot_mismatch", f"WITH {OBSERVATIONS_SQL} SELECT a.case_id, a.field, count(*) AS n FROM obs a JOIN obs b ON a.case_id = b.case_id AND a.field = b.field AND b.seq = 1 AND a.normalized_value <> b.normalized_value GROUP BY 1, 2")
def _(s, sf):
    o = _normalized(s, sf)
    first = o.where("seq = 1").select("case_id", "field", F.col("normalized_value").alias("expected"))
    return o.join(first, ["case_id", "field"]).where("NOT (normalized_value <=> expected)").groupBy("case_id", "field").agg(F.count(F.lit(1)).alias("n"))


@query("set_missing_extra", "SELECT c_nationkey AS k, 'missing' AS side FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey < 12) GROUP BY 1 UNION ALL SELECT DISTINCT s_nationkey, 'extra' FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey < 12)")
def _(s, sf):
    c, p = t(s, sf, "customer").select(F.col("c_nationkey").alias("k")), t(s, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.subtract(p.where("k < 12")).withColumn("side", F.lit("missing")).union(p.subtract(c.where("k < 12")).withColumn("side", F.lit("extra")))


@query("set_union_revoked", "SELECT v AS sponsor_id FROM (VALUES ('SPN-0007'), ('SPN-0139'), ('SPN-4040'), ('SPN-9090'), ('SPN-2718'), ('SPN-7331')) t(v)")
def _(s, sf):
    listed = s.sql("SELECT explode(array(%s)) AS sponsor_id" % ", ".join(f"'{x}'" for x in vocab.REVOKED_LISTED))
    return listed.union(s.sql("SELECT explode(array(%s)) AS sponsor_id" % ", ".join(f"'{x}'" for x in vocab.REVOKED_INFERRED))).distinct()


@query("set_flag_algebra", """
SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN p_size % 2 = 0 THEN 'biohazard_red' END, CASE WHEN p_size % 3 = 0 THEN 'identity_conflict' END, CASE WHEN p_size % 5 = 0 THEN 'active_warrant' END], lambda x: x IS NOT NULL))), '|') AS flags,
  p_size % 2 = 0 OR p_size % 5 = 0 AS disqualifying FROM part WHERE p_size % 2 = 0 OR p_size % 3 = 0 OR p_size % 5 = 0""")
def _(s, sf):
    z = F.col("p_size")
    a = F.array_compact(F.array(F.when(z % 2 == 0, "biohazard_red"), F.when(z % 3 == 0, "identity_conflict")))
    b = F.array_compact(F.array(F.when(z % 5 == 0, "active_warrant"), F.lit("none")))
    flags = derive.merged_flags(a, b)
    bad = F.size(F.array_intersect(F.split(flags, r"\|"), F.array(*[F.lit(x) for x in vocab.DISQUALIFYING]))) > 0
    return t(s, sf, "part").select("p_partkey", flags.alias("flags"), bad.alias("disqualifying")).where("flags <> 'none'")


# Scoring -------------------------------------------------------------------------------------


@query("score_confusion", f"WITH {SCORED_SQL} SELECT truth, coalesce(pred, 'MISSING') AS pred, count(*) AS n FROM scored GROUP BY 1, 2")
def _(s, sf):
    return evaluate.confusion(scored(s, sf))


@query("score_case_points", f"WITH {SCORED_SQL} SELECT doc_id, CASE WHEN pred IS NULL THEN 0 WHEN truth = pred THEN 8 WHEN truth = 'DENIED' AND pred = 'APPROVED' THEN -4 WHEN truth <> 'NEEDS_REVIEW' AND pred = 'NEEDS_REVIEW' THEN 2 WHEN truth = 'NEEDS_REVIEW' THEN 1 ELSE 0 END AS points FROM scored")
def _(s, sf):
    return scored(s, sf).select("doc_id", F.when(F.col("pred").isNull(), 0).otherwise(evaluate.class_points(F.col("truth"), F.col("pred"))).alias("points"))


@query("score_sections", f"""WITH {SCORED_SQL}, p AS (SELECT *, CASE WHEN pred IS NULL THEN 0 WHEN truth = pred THEN 8 WHEN truth = 'DENIED' AND pred = 'APPROVED' THEN -4 WHEN truth <> 'NEEDS_REVIEW' AND pred = 'NEEDS_REVIEW' THEN 2 WHEN truth = 'NEEDS_REVIEW' THEN 1 ELSE 0 END AS pts FROM scored)
SELECT count(*) AS cases, CAST(sum(pts) AS BIGINT) AS raw_points, count(*) * 8 AS most_points, count(*) FILTER (pred IS NULL) AS missing, CAST(80 AS DOUBLE) * (CAST(sum(pts) AS DOUBLE) / (count(*) * 8)) AS class_score,
 least(CAST(10 AS DOUBLE), CAST(10 AS DOUBLE) * (CAST(count(*) FILTER (pred IS NULL) AS DOUBLE) / count(*))) AS missing_penalty FROM p""")
def _(s, sf):
    return evaluate.sections(scored(s, sf))


@query("score_brier", f"WITH {SCORED_SQL}, b AS (SELECT sum((doc_id % 100 - CASE WHEN truth = pred THEN 100 ELSE 0 END) * (doc_id % 100 - CASE WHEN truth = pred THEN 100 ELSE 0 END)) AS q, count(*) AS n FROM scored WHERE pred IS NOT NULL) SELECT round(CAST(q AS DOUBLE) / n / 10000, 9) AS mean_brier, round(20.0 * greatest(0.0, 1 - 2 * (CAST(q AS DOUBLE) / n / 10000)), 9) AS calibration FROM b")
def _(s, sf):
    return evaluate.brier(scored(s, sf)).select(F.round("mean_brier", 9).alias("mean_brier"), F.round("calibration", 9).alias("calibration"))


@query("validate_rows", r"""
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey >= 10000 THEN 'case_id' END, CASE WHEN o_custkey >= 1000 THEN 'sponsor_id' END, CASE WHEN o_orderkey % 7 = 0 THEN 'arrival_date' END,
  CASE WHEN o_orderkey % 4 = 3 THEN 'fee_status' END, CASE WHEN o_orderstatus = 'P' THEN 'adjudication' END, CASE WHEN o_orderkey % 3 = 0 THEN 'confidence' END], lambda x: x IS NOT NULL), ',') AS errors FROM orders""")
def _(s, sf):
    k = F.col("o_orderkey")
    columns = {
        "case_id": F.when(k < 10000, F.concat(F.lit("MIB-"), F.lpad(k.cast("string"), 6, "0"))).otherwise(F.concat(F.lit("MIB-"), k.cast("string"), F.lit("x"))),
        "sponsor_id": F.when(F.col("o_custkey") < 1000, F.concat(F.lit("SPN-"), F.lpad(F.col("o_custkey").cast("string"), 4, "0"))).otherwise("SPN-12"),
        "arrival_date": F.when(k % 7 == 0, "2026-99-99").otherwise("2026-01-05"), "fee_status": pick(k % 4, ("paid", "waived", "unpaid", "PAID")),
        "adjudication": F.when(F.col("o_orderstatus") == "O", "APPROVED").when(F.col("o_orderstatus") == "F", "DENIED").otherwise("approved"), "confidence": pick(k % 3, ("1.01", "0.9", "1")),
    }
    return t(s, sf, "orders").select("o_orderkey", evaluate.row_errors(columns).alias("errors"))


# Normalizers ---------------------------------------------------------------------------------


def _one(name: str, sql: str, written, f):
    @query(name, f"SELECT o_orderkey, {sql} AS v FROM orders")
    def _(s, sf):
        raw = written(F.col("o_orderkey"))
        if isinstance(f, str):
            return normalize.normalized(t(s, sf, "orders").select("o_orderkey", F.lit(f).alias("field"), raw.alias("raw_value")), out="v").select("o_orderkey", "v")
        return t(s, sf, "orders").select("o_orderkey", f(raw).alias("v"))


def _damaged(k: Column, read: str, damaged: str) -> Column:
    """A value and a damaged reading of it, in turn."""
    return F.when(k % 8 < 4, read).otherwise(damaged)


_one("norm_case_id", "'MIB-' || translate(lpad(CAST(o_orderkey AS VARCHAR), 6, '0'), '', '')", lambda k: F.concat(F.lit(" mib_"), F.translate(F.lpad(k.cast("string"), 6, "0"), "01", "OL")), normalize.case_id)
_one("norm_case_candidate", "CASE WHEN o_orderkey % 3 <> 1 THEN 'MIB-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') END", lambda k: F.concat(F.lit("mib "), F.translate(F.lpad((k % 1000000).cast("string"), 6, "0"), "01", "Oi"), F.when(k % 3 == 1, "X").otherwise("")), normalize.case_id_candidate)
_one("norm_sponsor_id", "'SPN-' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')", lambda k: F.concat(F.lit("spn "), F.translate(F.lpad((k % 10000).cast("string"), 4, "0"), "01", "oi")), normalize.sponsor_id)
_one("norm_visa_alias", "['XW-1', 'MED-3', 'TRANSIT-7', NULL][o_orderkey % 4 + 1]", lambda k: pick(k % 4, (_damaged(k, "x w1", "XWV-1"), _damaged(k, "MED-3", "MFD-3"), " transit7", "zzz")), "visa_class")
_one("norm_fee_status", "['paid', 'unpaid', 'unknown', 'other'][o_orderkey % 4 + 1]", lambda k: pick(k % 4, (" PA1D ", "unpaid", "UNKN0WN", "0ther")), normalize.fee_status)
_one("norm_date", "['2026-01-05', '2026-01-05', '2026-99-99', '20260105', NULL][o_orderkey % 5 + 1]", lambda k: pick(k % 5, ("2026-1-5", "2026/01/05", "2026-99-99", "20260105", "")), normalize.date)
_one("norm_flags", "['active_warrant|biohazard_red', 'none', 'identity_conflict', NULL][o_orderkey % 4 + 1]", lambda k: pick(k % 4, (_damaged(k, "Biohazard Red;active-warrant|biohazard_red", "biohazard_rcd|act1ve warrant"), "NONE", _damaged(k, "identity conflict,none", "identlty conflict,none"), "zz")), "risk_flags")
_one("norm_species", "['ORION_GRAYS', 'KAIJU_MICRO'][o_orderkey % 2 + 1]", lambda k: pick(k % 2, (_damaged(k, " orion - grays_", "ORI0N GRAY5"), "kaiju  micro")), "species_code")
_one("norm_waiver", "['N/A', 'DIP-WAIVER'][o_orderkey % 2 + 1]", lambda k: pick(k % 2, ("not applicable", " dip-waiver ")), normalize.waiver_code)


@query("amount_waiver_fee", """
WITH a AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN CAST(0 AS DOUBLE) WHEN l_linenumber = 2 THEN NULL ELSE CAST(1234.5 AS DOUBLE) END AS amount,
  CASE WHEN l_returnflag = 'R' THEN 'present' WHEN l_returnflag = 'A' THEN 'absent' ELSE 'unknown' END AS waiver FROM lineitem)
SELECT l_linenumber, waiver, CASE WHEN amount IS NULL AND waiver = 'present' THEN 'waived' WHEN amount > 0 AND waiver <> 'present' THEN 'paid' WHEN amount = 0 AND waiver = 'present' THEN 'waived' END AS fee, count(*) AS n FROM a GROUP BY ALL""")
def _(s, sf):
    amount = normalize.amount(F.when(F.col("l_linenumber") == 1, "$0").when(F.col("l_linenumber") == 2, ",").otherwise("USD 1,234.5"))
    waiver = derive.waiver_class(F.when(F.col("l_returnflag") == "R", "dip-waiver").when(F.col("l_returnflag") == "A", " n/a ").otherwise("?"))
    return t(s, sf, "lineitem").select("l_linenumber", waiver.alias("waiver"), derive.fee_from_amount(amount, waiver).alias("fee")).groupBy("l_linenumber", "waiver", "fee").agg(F.count(F.lit(1)).alias("n"))


@query("risk_from_status_text", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'active_warrant' END AS flag, p_size % 2 = 0 AS embargo FROM part")
def _(s, sf):
    z = F.col("p_size")
    reason = pick(z % 3, ("Denied: ACTIVE_WARRANT on file", "biohazard_red or active_warrant", "nothing"))
    status = pick(z % 2, ("Under Embargo", "clear"))
    return t(s, sf, "part").select("p_partkey", derive.reason_flag(reason).alias("flag"), F.upper(status).contains("EMBARGO").alias("embargo"))


@query("adjudicate_cases", f"""WITH {WIDE_SQL}, r AS (SELECT case_id, CASE
  WHEN said IS NOT NULL THEN 'adjudicator_note' WHEN visa IS DISTINCT FROM 'DIP-1' AND age > 180 THEN 'stale_application' WHEN flag = 'biohazard_red' THEN 'disqualifying_risk_flag'
  WHEN visa = 'TRANSIT-7' THEN 'transit_visa_class' WHEN fee = 'unpaid' THEN 'unpaid_fee' WHEN sponsor IN ('SPN-0007', 'SPN-0139', 'SPN-4040', 'SPN-9090', 'SPN-2718', 'SPN-7331') AND visa IS DISTINCT FROM 'DIP-1' THEN 'revoked_sponsor'
  WHEN fee IS NULL OR fee = 'unknown' THEN 'unresolved_fee' WHEN flag = 'identity_conflict' THEN 'review_risk_flag' WHEN sponsor IS NULL AND visa IS DISTINCT FROM 'DIP-1' THEN 'missing_sponsor'
  WHEN visa IS NULL OR conflicting THEN 'insufficient_evidence' WHEN fee IN ('paid', 'waived') THEN 'clean_packet' ELSE 'fallback' END AS rule, said FROM wide)
SELECT case_id, rule, CASE rule WHEN 'adjudicator_note' THEN said WHEN 'clean_packet' THEN 'APPROVED' WHEN 'stale_application' THEN 'DENIED' WHEN 'disqualifying_risk_flag' THEN 'DENIED' WHEN 'transit_visa_class' THEN 'DENIED' WHEN 'unpaid_fee' THEN 'DENIED' WHEN 'revoked_sponsor' THEN 'DENIED' ELSE 'NEEDS_REVIEW' END AS decision,
 CAST(CASE rule WHEN 'adjudicator_note' THEN 0.95 WHEN 'stale_application' THEN 0.90 WHEN 'disqualifying_risk_flag' THEN 0.93 WHEN 'transit_visa_class' THEN 0.92 WHEN 'unpaid_fee' THEN 0.92 WHEN 'revoked_sponsor' THEN 0.76 WHEN 'unresolved_fee' THEN 0.88 WHEN 'review_risk_flag' THEN 0.76 WHEN 'missing_sponsor' THEN 0.70 WHEN 'insufficient_evidence' THEN 0.72 WHEN 'clean_packet' THEN 0.82 ELSE 0.60 END AS DOUBLE) AS confidence FROM r""")
def _(s, sf):
    c = wide_cases(s, sf)
    made = derive.adjudicated(*[F.col(x) for x in ("note", "visa_class", "arrival_date")], F.array(F.col("flag")), F.col("fee_status"), F.col("sponsor_id"), F.col("conflicting"))
    return c.select("case_id", made.alias("a")).select("case_id", "a.rule", "a.decision", F.col("a.confidence").cast("double").alias("confidence"))


# Observations and resolution -----------------------------------------------------------------


def _normalized(s, sf):
    return normalize.normalized(resolve.exploded(observations(s, sf)))


@query("observations_explode", f"WITH {OBSERVATIONS_SQL} SELECT field, normalized_value, count(*) AS n FROM obs GROUP BY 1, 2")
def _(s, sf):
    return _normalized(s, sf).groupBy("field", "normalized_value").agg(F.count(F.lit(1)).alias("n"))


@query("corroborate_exact", f"""WITH {OBSERVATIONS_SQL}, c AS (SELECT case_id, field, lower(normalized_value) AS folded, min(tier) AS tier, count(DISTINCT document_type) AS types, max(source) AS source, min(page_number * 1000 + seq) AS first, any_value(normalized_value) AS value FROM tiered GROUP BY 1, 2, 3),
 r AS (SELECT *, lead(tier) OVER w AS next_tier, row_number() OVER w AS n FROM c WINDOW w AS (PARTITION BY case_id, field ORDER BY tier, types DESC, source DESC, first))
SELECT case_id, field, CASE WHEN tier >= next_tier THEN NULL ELSE value END AS resolved_value, CASE WHEN tier >= next_tier THEN 'conflicting' WHEN next_tier IS NOT NULL THEN 'resolved_by_evidence_priority' WHEN types > 1 THEN 'corroborated' ELSE 'single_source' END AS status FROM r WHERE n = 1""")
def _(s, sf):
    return resolve.resolved_exact(_normalized(s, sf))


@query("corroborate_native_ocr", f"""WITH {OBSERVATIONS_SQL}, c AS (SELECT case_id, field, lower(normalized_value) AS folded, min(tier) AS tier, count(DISTINCT document_type) AS types, max(source) AS source, min(page_number * 1000 + seq) AS first, count(*) AS size, any_value(normalized_value) AS value FROM tiered GROUP BY 1, 2, 3),
 r AS (SELECT *, lead(tier) OVER w AS next_tier, row_number() OVER w AS n FROM c WINDOW w AS (PARTITION BY case_id, field ORDER BY tier, types DESC, source DESC, first))
SELECT case_id, field, CASE WHEN tier >= next_tier THEN NULL ELSE value END AS resolved_value, CASE WHEN tier >= next_tier THEN 'conflicting' WHEN next_tier IS NOT NULL THEN 'resolved_by_evidence_priority' WHEN types > 1 THEN 'corroborated' ELSE 'single_source' END AS status,
 CASE WHEN tier >= next_tier THEN 'equal_priority_conflict' WHEN next_tier IS NOT NULL THEN 'evidence_priority' WHEN size = 1 THEN 'single_observation' ELSE 'exact_match' END AS resolution_method FROM r WHERE n = 1""")
def _(s, sf):
    """The fold with prefix matches, native preference and shape rescue. These readings have no noise, so SQL can group them; the tests have the rest."""
    return resolve.resolved(_normalized(s, sf))


@query("resolved_wide", f"""WITH {OBSERVATIONS_SQL}, c AS (SELECT case_id, field, lower(normalized_value) AS folded, min(tier) AS tier, count(DISTINCT document_type) AS types, max(source) AS source, min(page_number * 1000 + seq) AS first, any_value(normalized_value) AS value FROM tiered GROUP BY 1, 2, 3),
 r AS (SELECT *, lead(tier) OVER w AS next_tier, row_number() OVER w AS n FROM c WINDOW w AS (PARTITION BY case_id, field ORDER BY tier, types DESC, source DESC, first)),
 v AS (SELECT case_id, field, CASE WHEN tier >= next_tier THEN NULL ELSE value END AS value FROM r WHERE n = 1)
SELECT case_id, max(value) FILTER (field = 'visa_class') AS visa_class, max(value) FILTER (field = 'fee_status') AS fee_status FROM v GROUP BY case_id""")
def _(s, sf):
    w = resolve.wide(resolve.resolved_exact(_normalized(s, sf)), ["visa_class", "fee_status"])
    return w.select("case_id", F.col("visa_class_value").alias("visa_class"), F.col("fee_status_value").alias("fee_status"))


# Pages ---------------------------------------------------------------------------------------

@query("classify_pages", "SELECT p_size % 4 AS k, ['fee_receipt', 'intake_form', 'unknown', 'adjudicator_note'][p_size % 4 + 1] AS document_type, [19, 12, 1, 16][p_size % 4 + 1] AS score, count(*) AS n FROM part GROUP BY 1, 2, 3")
def _(s, sf):
    text = pick(F.col("p_size") % 4, ("MIB Fee Receipt - Fee Status: PAID; amount paid 7, waiver", "Applicant Intake: Species-Code X, home world Y, visa class", "Applieant", "Adjudicator Note: decision"))
    c = t(s, sf, "part").select((F.col("p_size") % 4).alias("k"), pages.classified(text).alias("c"))
    return c.groupBy("k", "c.document_type", "c.score").agg(F.count(F.lit(1)).alias("n"))


@query("extract_labelled_fields", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN ['paid', 'waived', 'unpaid', 'unknown'][o_custkey % 4 + 1] END AS fee_status, CASE WHEN o_orderkey % 3 <> 0 THEN '1,' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') || '.50' END AS amount,
 CASE WHEN o_orderkey % 2 = 0 THEN 'WVR-' || o_custkey ELSE 'N/A' END AS waiver_code, lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS digits FROM orders""")
def _(s, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat_ws(
        " ", F.lit("MIB FEE RECEIPT"), F.when(o % 2 == 0, "Case 1D;").otherwise("Case ID"), F.concat(F.lit("MIB-"), F.lpad((o % 1000000).cast("string"), 6, "0")),
        F.when(o % 5 != 0, F.concat(F.lit("Fee  Status: "), pick(c % 4, vocab.FEE_STATUSES))), F.when(o % 3 != 0, F.concat(F.lit("Amount - $ 1,"), F.lpad((c % 1000).cast("string"), 3, "0"), F.lit(".50"))),
        F.lit("Waiver Code."), F.when(o % 2 == 0, F.concat(F.lit("WVR-"), c.cast("string"))).otherwise("N/A"),
    )
    m = t(s, sf, "orders").select("o_orderkey", pages.field_map(text, "fee_receipt").alias("f"))
    return m.select("o_orderkey", m.f["fee_status"].alias("fee_status"), m.f["amount"].alias("amount"), m.f["waiver_code"].alias("waiver_code"), F.substr(m.f["case_id"], F.lit(5)).alias("digits"))


@query("intake_fields", f"""SELECT o_orderkey, 'Zed Quill ' || chr(CAST(65 + o_custkey % 26 AS INT)) AS applicant, CASE WHEN o_orderkey % 3 <> 0 THEN {list(vocab.SPECIES)}[o_custkey % {len(vocab.SPECIES)} + 1] END AS species_code, {list(vocab.HOME_WORLDS)}[o_custkey % {len(vocab.HOME_WORLDS)} + 1] AS home_world,
 CASE WHEN o_orderkey % 5 <> 0 THEN {list(vocab.VISA_CLASSES)}[o_custkey % 5 + 1] END AS visa_class, 'SPN ' || o_custkey AS sponsor_id, '2026-0' || (o_custkey % 9 + 1) || '.07' AS arrival_date, {list(vocab.PURPOSES)}[o_custkey % {len(vocab.PURPOSES)} + 1] AS declared_purpose FROM orders""")
def _(s, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    labelled_as = lambda good, bad: F.when(o % 2 == 0, good).otherwise(bad)
    text = F.concat_ws(
        " ", F.lit("Applicant: Zed Quill"), F.char(65 + c % 26), F.when(o % 3 != 0, F.concat(F.lit("Species Code: "), pick(c % len(vocab.SPECIES), vocab.SPECIES))), F.lit("Home World -"), pick(c % len(vocab.HOME_WORLDS), vocab.HOME_WORLDS),
        F.when(o % 5 != 0, F.concat_ws(" ", labelled_as("Visa Class:", "Visa Close;"), pick(c % 5, vocab.VISA_CLASSES))), labelled_as("Sponsor ID: SPN", "Sponsor 1D = SPN"), c.cast("string"), F.concat(labelled_as("Arrival Date: 2026-0", "Amival Date 2026-0"), (c % 9 + 1).cast("string"), F.lit(".07")),
        F.lit("Declared Purpose:"), pick(c % len(vocab.PURPOSES), vocab.PURPOSES), F.when(o % 4 == 0, "SAMPLE  DENIAL").otherwise("Packet MIB-000001 / page 1"),
    )
    m = t(s, sf, "orders").select("o_orderkey", pages.extracted(F.lit("intake_form"), text).alias("f"))
    return m.select("o_orderkey", *[m.f[x].alias(x) for x in ("applicant", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose")])


@query("slip_fields", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Zed Quill' END AS applicant, {list(vocab.SPECIES)}[o_custkey % {len(vocab.SPECIES)} + 1] AS species_match, (o_custkey % 100) || ' %' AS biometric_confidence, CASE WHEN o_orderkey % 3 <> 0 THEN {list(vocab.RISK_FLAGS)}[o_custkey % {len(vocab.RISK_FLAGS)} + 1] || '|none' END AS observed_flags FROM orders""")
def _(s, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat_ws(
        " ", F.lit("Biometric Scan Slip"), F.when(o % 2 == 0, "Applicant: Zed Quill |"), F.lit("Species Match:"), pick(c % len(vocab.SPECIES), vocab.SPECIES), F.lit("— Biometric confidence:"), (c % 100).cast("string"), F.lit("%"),
        F.when(o % 3 != 0, F.concat(F.lit("Observed flags: "), pick(c % len(vocab.RISK_FLAGS), vocab.RISK_FLAGS), F.lit("|none"))), F.lit("SCAN IMAGE"),
    )
    m = t(s, sf, "orders").select("o_orderkey", pages.extracted(F.lit("biometric_slip"), text).alias("f"))
    return m.select("o_orderkey", *[m.f[x].alias(x) for x in ("applicant", "species_match", "biometric_confidence", "observed_flags")])


@query("attestation_fields", f"""SELECT o_orderkey, 'SPN-' || o_custkey AS sponsor_id, 'Zed Quill ' || chr(CAST(65 + o_custkey % 26 AS INT)) AS applicant, {list(vocab.PURPOSES)}[o_custkey % {len(vocab.PURPOSES)} + 1] AS purpose, {list(vocab.VISA_CLASSES)}[o_custkey % 5 + 1] AS visa_class FROM orders""")
def _(s, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    name, purpose, visa, sponsor = F.concat(F.lit("Zed Quill "), F.char(65 + c % 26)), pick(c % len(vocab.PURPOSES), vocab.PURPOSES), pick(c % 5, vocab.VISA_CLASSES), F.concat(F.lit("SPN-"), c.cast("string"))
    table = F.concat_ws(" ", F.lit("Sponsor Attestation Sponsor ID:"), sponsor, F.lit("Applicant:"), name, F.lit("Purpose:"), purpose, F.lit("Visa Class:"), visa, F.lit("Packet MIB-1 / page 4"))
    letter = F.concat(F.lit("Sponsor "), sponsor, F.lit(" attests that "), name, F.lit(" is expected on Earth for "), purpose, F.lit(". We accept responsibility for class "), visa, F.lit(" compliance."))
    m = t(s, sf, "orders").select("o_orderkey", pages.extracted(F.lit("sponsor_attestation"), F.when(o % 2 == 0, table).otherwise(letter)).alias("f"))
    return m.select("o_orderkey", *[m.f[x].alias(x) for x in ("sponsor_id", "applicant", "purpose", "visa_class")])


@query("extract_first_of", "SELECT o_orderkey, 'SPN-' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS sponsor_id, 'Zed Quill' AS applicant FROM orders")
def _(s, sf):
    text = F.concat(F.lit("Sponsor SPN-"), F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0"), F.lit(" attests that Zed Quill is expected on Earth for research."))
    m = t(s, sf, "orders").select("o_orderkey", pages.extracted(F.lit("none"), text).alias("f"))
    return m.select("o_orderkey", m.f["sponsor_id"].alias("sponsor_id"), m.f["applicant"].alias("applicant"))


@query("correction_notes", f"""SELECT o_orderkey, 'SPN-' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS sponsor_id, CASE WHEN o_orderkey % 3 = 0 THEN 'waived' ELSE {list(vocab.FEE_STATUSES)}[o_custkey % 4 + 1] END AS fee_status, CASE WHEN o_orderkey % 2 = 0 THEN {list(vocab.HOME_WORLDS)}[o_custkey % {len(vocab.HOME_WORLDS)} + 1] END AS home_world,
 CASE WHEN o_orderkey % 5 <> 0 THEN {list(vocab.VISA_CLASSES)}[o_custkey % 5 + 1] END AS visa_class FROM orders""")
def _(s, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat_ws(
        "\n", F.concat(F.lit("Manual correction: fee status is "), F.upper(pick(c % 4, vocab.FEE_STATUSES)), F.lit(".")), F.concat(F.lit("manual  correction : the sponsor is spn-"), F.lpad((c % 10000).cast("string"), 4, "0"), F.lit(".")),
        F.when(o % 3 == 0, "Manual correction: fee status is WAIVED, not paid"), F.when(o % 2 == 0, F.concat(F.lit("Manual correction: home world is  "), pick(c % len(vocab.HOME_WORLDS), vocab.HOME_WORLDS), F.when(o % 4 == 0, "; see file").otherwise(""))),
        F.when(o % 5 == 0, "Manual correction: visa class is unclear").otherwise(F.concat(F.lit("Manual correction: visa class is "), F.lower(pick(c % 5, vocab.VISA_CLASSES)), F.lit(" | x"))),
    )
    m = t(s, sf, "orders").select("o_orderkey", pages.corrections(text).alias("f"))
    return m.select("o_orderkey", *[m.f[x].alias(x) for x in ("sponsor_id", "fee_status", "home_world", "visa_class")])


@query("suspicious_text", r"SELECT doc_id, regexp_matches(lower(text), '\btoken\s*=') AS a, regexp_matches(lower(text), '\bpassword\b') AS b FROM documents WHERE regexp_matches(lower(text), '\btoken\s*=') OR regexp_matches(lower(text), '\bpassword\b')")
def _(s, sf):
    found = pages.suspicious(F.col("text"), (r"\btoken\s*=", r"\bpassword\b"))
    d = t(s, sf, "documents").select("doc_id", found.alias("f")).where(F.size("f") > 0)
    return d.select("doc_id", F.array_contains("f", r"\btoken\s*=").alias("a"), F.array_contains("f", r"\bpassword\b").alias("b"))


def _spans(s, sf):
    k = F.col("o_orderkey")
    box = lambda x0, x1: F.struct(x0.cast("double").alias("x0"), F.lit(0.0).alias("y0"), x1.cast("double").alias("x1"), F.lit(10.0).alias("y1"))
    span = lambda text, color, b: F.struct(F.lit(text).alias("text"), color.cast("int").alias("color"), b.alias("bbox"))
    spans = F.array(span("ink", F.lit(0), box(F.lit(0), F.lit(50))), span("pale", F.when(k % 2 == 0, 0xFFFFFF).otherwise(0x808080), box(F.lit(0), F.lit(50))), span("edge", F.lit(0), box(F.lit(-20) - k % 40, F.lit(40))), span(" ", F.lit(0), box(F.lit(0), F.lit(9))))
    return t(s, sf, "orders").select("o_orderkey", spans.alias("spans"))


@query("visible_text", "SELECT o_orderkey, 'ink' || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE ' pale' END || CASE WHEN 40.0 / (60 + o_orderkey % 40) >= 0.5 THEN ' edge' ELSE '' END AS v FROM orders")
def _(s, sf):
    return _spans(s, sf).select("o_orderkey", pages.visible_text(F.col("spans"), F.lit(100.0), F.lit(100.0)).alias("v"))


@query("hidden_text", "SELECT o_orderkey, trim(CASE WHEN o_orderkey % 2 = 0 THEN 'pale' ELSE '' END || CASE WHEN 40.0 / (60 + o_orderkey % 40) < 0.5 THEN ' edge' ELSE '' END) AS v FROM orders")
def _(s, sf):
    return _spans(s, sf).select("o_orderkey", pages.hidden_text(F.col("spans"), F.lit(100.0), F.lit(100.0)).alias("v"))


@query("route_pages", """SELECT CASE WHEN l_linenumber = 1 THEN 'native_text' WHEN l_returnflag = 'R' THEN 'standard_ocr' WHEN l_linestatus = 'O' THEN 'degraded_scan_ocr' ELSE 'ocr_fallback' END AS extraction_method,
 CASE WHEN l_linenumber = 1 THEN 'none' WHEN l_returnflag = 'R' THEN 'suspicious_text_layer' WHEN l_linestatus = 'O' THEN 'degraded_scan' ELSE 'fallback' END AS ocr_strategy, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(s, sf):
    r = pages.route(F.col("l_linenumber") == 1, F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "O", "scan_degraded").otherwise("insufficient_evidence"))
    return t(s, sf, "lineitem").select(r.alias("r")).groupBy("r.extraction_method", "r.ocr_strategy").agg(F.count(F.lit(1)).alias("n"))


@query("missing_markers", f"""WITH m AS (SELECT o_orderkey, {[f for f in vocab.MISSING_MARKERS]}[o_orderkey % {len(vocab.MISSING_MARKERS)} + 1] AS field, {[f for f in vocab.MISSING_MARKERS]}[o_custkey % {len(vocab.MISSING_MARKERS)} + 1] AS shown FROM orders) SELECT o_orderkey, CASE WHEN field = shown THEN {[m[-1] for m in vocab.MISSING_MARKERS.values()]}[o_orderkey % {len(vocab.MISSING_MARKERS)} + 1] END AS marker FROM m""")
def _(s, sf):
    fields, marks, n = tuple(vocab.MISSING_MARKERS), tuple(m[-1] for m in vocab.MISSING_MARKERS.values()), len(vocab.MISSING_MARKERS)
    text = F.concat(F.lit("Some words, "), F.lower(pick(F.col("o_custkey") % n, marks)), F.lit(" and more"))
    return t(s, sf, "orders").select("o_orderkey", pages.missing_marker(pick(F.col("o_orderkey") % n, fields), text).alias("marker"))


@query("orphan_lines", r"SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda l: length(l) >= 3 AND NOT regexp_matches(l, '(?i)packet|page\s+\d|synthetic\s+hiring|mib\s+eyes\s+only|scan\s+image|passport\s+image|registry\s+image|form\s+[bi][-\s]?\d+') AND NOT contains(lower(l), 'the'))) AS n FROM documents")
def _(s, sf):
    return t(s, sf, "documents").select("doc_id", F.size(observe.orphans(F.split("text", "\n"), F.array(F.lit("The"), F.lit(""), F.lit(None)))).cast("bigint").alias("n"))


# Identity ------------------------------------------------------------------------------------


@query("case_id_precedence", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 'footer' WHEN l_linenumber % 2 = 0 THEN 'header' ELSE 'internal' END AS method, (l_linenumber % 3 = 0 OR l_linenumber % 2 = 0) AND l_partkey % 2 = 0 AS mismatch, count(*) AS n FROM lineitem GROUP BY ALL")
def _(s, sf):
    n, a = F.col("l_linenumber"), _case("l_orderkey")
    other = F.when(F.col("l_partkey") % 2 == 0, F.concat(a, F.lit("9"))).otherwise(a)
    i = identity.structural_id(F.when(n % 3 == 0, a), F.when(n % 2 == 0, a), other)
    return t(s, sf, "lineitem").select("l_orderkey", "l_linenumber", i.alias("i")).groupBy("l_orderkey", "l_linenumber", "i.method", "i.mismatch").agg(F.count(F.lit(1)).alias("n"))


@query("case_id_established", "SELECT l_suppkey AS packet, l_partkey AS case_id, count(*) AS pages FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(s, sf):
    return identity.established(t(s, sf, "lineitem").select(F.col("l_suppkey").alias("packet"), F.col("l_partkey").alias("case_id")))


@query("pages_per_case", "SELECT l_suppkey AS packet, l_partkey AS case_id, array_to_string(list_sort(list_distinct(list(CAST(l_linenumber AS VARCHAR)))), ',') AS pages, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(s, sf):
    return identity.pages_per_case(t(s, sf, "lineitem").select(F.col("l_suppkey").alias("packet"), F.col("l_partkey").alias("case_id"), F.col("l_linenumber").alias("page_number")))


def _read_pages(s, sf) -> DataFrame:
    """Line items as pages with four fields; returned ones do not tell their case."""
    o = _normalized(s, sf)
    return o.select("case_id", "page_number", "field", F.col("normalized_value").alias("value"), (F.col("text_source") == "ocr").alias("lost"))


@query("link_pages_exactly", f"""WITH {OBSERVATIONS_SQL}, p AS (SELECT substr(case_id, 1, 8) AS packet, case_id, page_number, field, normalized_value AS v, text_source = 'ocr' AS lost FROM obs),
a AS (SELECT packet, case_id || '-' || page_number AS page, field, list_distinct(list(v)) AS vs FROM p WHERE lost GROUP BY ALL), b AS (SELECT packet, case_id, field, list_distinct(list(v)) AS vs FROM p WHERE NOT lost GROUP BY ALL),
m AS (SELECT a.packet, page, case_id, a.field, list_has_any(a.vs, b.vs) AS same FROM a JOIN b USING (packet, field)),
w AS (SELECT packet, page, case_id, CAST(sum(CASE WHEN same THEN CASE field WHEN 'sponsor_id' THEN 6 WHEN 'arrival_date' THEN 3 WHEN 'visa_class' THEN 2 ELSE 0 END ELSE -CASE field WHEN 'sponsor_id' THEN 7 WHEN 'arrival_date' THEN 3 WHEN 'visa_class' THEN 2 ELSE 0 END END) AS BIGINT) AS score,
 count(*) FILTER (same) AS matched, coalesce(string_agg(CASE WHEN NOT same THEN field END, ',' ORDER BY field), '') AS conflicts FROM m GROUP BY ALL),
r AS (SELECT *, row_number() OVER o AS n, coalesce(lead(score) OVER o, 0) AS second FROM w WINDOW o AS (PARTITION BY packet, page ORDER BY score DESC, case_id))
SELECT packet, page AS page_number, case_id, score, matched, conflicts, second, matched >= 2 AND score >= 7 AND score - second >= 3 AND NOT contains(',' || conflicts || ',', ',sponsor_id,') AS safe FROM r WHERE n = 1""")
def _(s, sf):
    o = _read_pages(s, sf).withColumn("packet", F.substring("case_id", 1, 8))
    return identity.link_scores(o.where("lost").select("packet", F.concat_ws("-", "case_id", "page_number").alias("page_number"), "field", "value"), o.where("NOT lost").select("packet", "case_id", "field", "value"))


@query("link_pages_to_cases")
def _(s, sf):
    """Pages of unknown case (returned lines), their names with noise, against the cases of their packet; the scores are tested on a fixture."""
    lost = F.col("l_returnflag") == "R"
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    name = F.concat_ws(" ", pick(k % 7, ("Oririx", "Zed", "Mo", "Ann", "Zevese", "Orikesh", "Tal")), pick(k % 11, ("Orivoss", "Quill", "Brask", "Bell", "Qorul", "Antari", "Venn", "Ul", "Dor", "Parque", "Stion")))
    noisy = F.when(n % 2 == 1, F.concat(F.translate(name, "e", "c"), F.lit(' Spr~- "te.'))).otherwise(F.translate(name, "i", "l"))
    names = t(s, sf, "lineitem").select(_case("l_orderkey").alias("case_id"), n.alias("page_number"), F.lit("applicant_name").alias("field"), F.when(lost, noisy).otherwise(name).alias("value"), lost.alias("lost"))
    o = _read_pages(s, sf).unionByName(names).withColumn("packet", F.substring("case_id", 1, 8))
    known = o.where("NOT lost").select("packet", "case_id", "field", "value")
    return identity.link_scores(o.where("lost").select("packet", F.concat_ws("-", "case_id", "page_number").alias("page_number"), "field", "value"), known)


@query("vocab_best_match")
def _(s, sf):
    """Nation names against the vocabulary of worlds; matching-block similarity has no SQL counterpart."""
    n = t(s, sf, "customer").join(F.broadcast(t(s, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat("n_name", F.lit("-b")).alias("written"))
    return similarity.with_best_match(n, "written", vocab.HOME_WORLDS, 0.3, 0.01)


# Triage --------------------------------------------------------------------------------------


def _queue(s, sf):
    e = errors(s, sf)
    e = e.withColumn("category", triage.error_category(F.col("expected"), F.col("predicted"), F.col("status")))
    e = e.withColumn("priority", triage.priority(F.col("field"), F.col("category"), F.col("status"), F.col("unassigned_pages"), F.col("unassigned")))
    return e.withColumn("weight", F.try_element_at(F.create_map(*[F.lit(x) for kv in vocab.FIELD_WEIGHTS.items() for x in kv]), F.col("field")))


@query("review_queue_topk", f"WITH {ERRORS_SQL}, d AS (SELECT DISTINCT priority, case_id, field FROM err) SELECT case_id, field, priority, row_number() OVER (ORDER BY priority DESC, case_id, field) AS review_rank FROM d ORDER BY priority DESC, case_id, field LIMIT 50")
def _(s, sf):
    top = triage.queue(_queue(s, sf).select("case_id", "field", "priority").distinct(), 50)
    return top.select("case_id", "field", "priority", F.col("review_rank").cast("bigint").alias("review_rank"))


@query("case_summary", f"WITH {ERRORS_SQL} SELECT case_id, count(*) AS errors, max(priority) AS top_priority, CAST(sum(weight) AS BIGINT) AS weighted, string_agg(DISTINCT field, '|' ORDER BY field) AS fields, string_agg(DISTINCT category, '|' ORDER BY category) AS categories, bool_and(reviewed) AS all_reviewed FROM err GROUP BY case_id")
def _(s, sf):
    return triage.case_summary(_queue(s, sf))


@query("root_cause_share", f"WITH {ERRORS_SQL} SELECT category, count(*) AS errors, CAST(sum(weight) AS BIGINT) AS weighted, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM err GROUP BY category")
def _(s, sf):
    return triage.root_causes(_queue(s, sf))


@query("flag_crosstab", "SELECT event_type, count(*) FILTER (user_id % 3 = 0) AS a, count(*) FILTER (user_id % 3 = 1) AS b, count(*) FILTER (user_id % 3 = 2) AS c FROM events GROUP BY 1")
def _(s, sf):
    e = t(s, sf, "events").withColumn("k", pick(F.col("user_id") % 3, ("a", "b", "c")))
    return e.groupBy("event_type").pivot("k", ["a", "b", "c"]).agg(F.count(F.lit(1))).na.fill(0)


@query("flag_combos", "SELECT combo, count(*) AS n FROM (SELECT user_id, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS combo, count(DISTINCT event_type) AS k FROM events GROUP BY 1) WHERE k >= 2 GROUP BY 1")
def _(s, sf):
    per = t(s, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("c")).where(F.size("c") >= 2)
    return per.groupBy(F.array_join("c", "|").alias("combo")).agg(F.count(F.lit(1)).alias("n"))


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(s, sf):
    return t(s, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("word_lines_group", "SELECT conv_id, string_agg(role, ' ' ORDER BY turn) AS text, min(turn) AS top, max(length(text)) AS \"right\" FROM conversations GROUP BY 1")
def _(s, sf):
    w = t(s, sf, "conversations").select("conv_id", F.col("turn").alias("word_no"), F.col("role").alias("text"), F.lit(0).alias("left"), F.col("turn").alias("top"), F.length("text").cast("bigint").alias("right"), F.lit(0).alias("bottom"), F.lit(-1.0).alias("conf"))
    return triage.word_lines(w, ["conv_id"]).select("conv_id", "text", "top", "right")


@query("candidate_keep_best", "SELECT l_orderkey, max_by(l_linenumber, (5 * l_linenumber % 7) * 100 - l_linenumber) AS best FROM lineitem GROUP BY 1")
def _(s, sf):
    return t(s, sf, "lineitem").groupBy("l_orderkey").agg(F.max_by("l_linenumber", (5 * F.col("l_linenumber") % 7) * 100 - F.col("l_linenumber")).alias("best"))


@query("islands_runs", """WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events), b AS (SELECT *, n - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM a WHERE value > 20)
SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM b GROUP BY user_id, g HAVING count(*) >= 3""")
def _(s, sf):
    return triage.islands(t(s, sf, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", F.col("value") > 20, 3)


@query("frame_continuity", "SELECT event_id, count(*) FILTER (value > 20) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS near FROM events")
def _(s, sf):
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(-10, 10)
    return t(s, sf, "events").select("event_id", F.count(F.when(F.col("value") > 20, 1)).over(w).alias("near"))


@query("median_mad", "WITH m AS (SELECT l_orderkey, median(l_quantity) AS med FROM lineitem GROUP BY 1) SELECT l_orderkey, med, median(abs(l_quantity - med)) AS mad FROM lineitem JOIN m USING (l_orderkey) GROUP BY 1, 2")
def _(s, sf):
    li = t(s, sf, "lineitem").select("l_orderkey", "l_quantity")
    m = li.groupBy("l_orderkey").agg(F.median("l_quantity").alias("med"))
    return li.join(m, "l_orderkey").groupBy("l_orderkey", "med").agg(F.median(F.abs(F.col("l_quantity") - F.col("med"))).alias("mad"))


@query("percentile_tier", "WITH p AS (SELECT l_suppkey, quantile_cont(l_quantity, 0.5) AS q FROM lineitem GROUP BY 1) SELECT l_suppkey, q, count(*) AS n FROM lineitem JOIN p USING (l_suppkey) WHERE l_quantity <= q GROUP BY 1, 2")
def _(s, sf):
    li = t(s, sf, "lineitem").select("l_suppkey", "l_quantity")
    p = li.groupBy("l_suppkey").agg(F.percentile("l_quantity", 0.5).alias("q"))
    return li.join(p, "l_suppkey").where("l_quantity <= q").groupBy("l_suppkey", "q").agg(F.count(F.lit(1)).alias("n"))


@query("grid_cross", "SELECT r_regionkey * 100 + n_nationkey AS config, CAST(0.5 * r_regionkey + 0.25 * n_nationkey AS DOUBLE) AS score FROM region, nation")
def _(s, sf):
    """The parameter grid: two literal dimensions, a few rows each."""
    r, n = t(s, sf, "region"), t(s, sf, "nation")
    return n.crossJoin(F.broadcast(r)).select((F.col("r_regionkey") * 100 + F.col("n_nationkey")).alias("config"), (F.lit(0.5) * F.col("r_regionkey") + F.lit(0.25) * F.col("n_nationkey")).cast("double").alias("score"))


# Whole packets, fields, series ---------------------------------------------------------------


def packet_pages(s, sf) -> DataFrame:
    """Orders as packets of three page texts, half of them with damaged readings."""
    k = F.col("o_orderkey")
    case = F.concat(F.lit("MIB-"), F.lpad((k % 1000000).cast("string"), 6, "0"))
    sponsor = F.concat(F.lit("SPN-"), F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0"))
    visa = pick(k % 5, tuple(_damaged(k, v, {"XW-1": "XWV-1", "MED-3": "MFD-3"}.get(v, v)) for v in vocab.VISA_CLASSES))
    flags = pick(k % 7, ("none", "none", "none", "none", _damaged(k, "biohazard_red", "biohazard_rcd"), "none", _damaged(k, "identity_conflict", "identlty_confict")))
    intake = F.concat(F.lit("MIB Intake Form Case ID: "), case, F.lit(" Applicant: Zed Quill Species Code: "), _damaged(k, "ORION_GRAYS", "ORI0N_GRAYS"), _damaged(k, " Home World: ", " Home Workt: "), _damaged(k, "Titan Freeport", "Tit\u00e1n FreepQrt"), F.lit(" Visa Class: "), visa, F.lit(" Sponsor ID: "), sponsor, F.lit(" Arrival Date: 2026-05-01 Declared Purpose: field repair Packet "), case, F.lit(" / page 1"))
    fee = F.concat(F.lit("MIB Fee Receipt Case ID: "), case, _damaged(k, " Fee Status: paid", " Foe Status: paid"), F.lit(" Amount: $"), F.when(k % 3 == 0, "0").otherwise("120.00"), F.lit(" Waiver Code: "), F.when(k % 6 == 0, "DIP-WAIVER").otherwise("N/A"))
    slip = F.concat(F.lit("Biometric Scan Slip Case ID: "), case, _damaged(k, "", " Applicant: (NAME CUT OLIT]"), F.lit(" Species Match: ORION_GRAYS Biometric confidence: 91% Observed flags: "), flags)
    # Dealt over all cores, since few bytes make many pages. Told apart by the order's key: a written id has room for six digits.
    orders = t(s, sf, "orders").select("o_orderkey", "o_custkey").repartition(int(s.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    rows = orders.select(k.cast("string").alias("case_id"), F.posexplode(F.array(intake, fee, slip)).alias("page_number", "text"))
    return rows.withColumn("text_source", F.lit("native_text"))


@query("predict_cases", """
WITH o AS (SELECT *, ['MED-3', 'DIP-1', 'XW-1', 'XW-2', 'TRANSIT-7'][o_orderkey % 5 + 1] AS visa, 'SPN-' || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS sponsor,
  ['none', 'none', 'none', 'none', 'biohazard_red', 'none', 'identity_conflict'][o_orderkey % 7 + 1] AS flags, CASE WHEN o_orderkey % 6 = 0 THEN 'waived' ELSE 'paid' END AS fee FROM orders),
r AS (SELECT *, CASE WHEN flags = 'biohazard_red' THEN 'disqualifying' WHEN visa = 'TRANSIT-7' THEN 'transit' WHEN sponsor IN ('SPN-0007', 'SPN-0139', 'SPN-4040', 'SPN-9090', 'SPN-2718', 'SPN-7331') AND visa <> 'DIP-1' THEN 'revoked' WHEN flags = 'identity_conflict' THEN 'review' ELSE 'clean' END AS rule FROM o)
SELECT 'MIB-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS case_id, 'Zed Quill' AS applicant_name, 'ORION_GRAYS' AS species_code, 'Titan Freeport' AS home_world, visa AS visa_class, sponsor AS sponsor_id, '2026-05-01' AS arrival_date, 'field repair' AS declared_purpose,
  flags AS risk_flags, fee AS fee_status, CASE rule WHEN 'review' THEN 'NEEDS_REVIEW' WHEN 'clean' THEN 'APPROVED' ELSE 'DENIED' END AS adjudication,
  CAST(CASE rule WHEN 'disqualifying' THEN 0.93 WHEN 'transit' THEN 0.92 WHEN 'revoked' THEN 0.76 WHEN 'review' THEN 0.76 ELSE 0.82 END AS DOUBLE) AS confidence FROM r""")
def _(s, sf):
    p = packet_pages(s, sf)
    return predict.predicted(p, p).withColumn("case_id", F.concat(F.lit("MIB-"), F.lpad((F.col("case_id").cast("bigint") % 1000000).cast("string"), 6, "0")))


@query("prediction_fallback", "SELECT 'MIB-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS case_id, 'NEEDS_REVIEW' AS adjudication, 'SPN-0000' AS sponsor_id, CAST(0.4 AS DOUBLE) AS confidence FROM part")
def _(s, sf):
    from ..sources.writers import baseline

    return baseline(t(s, sf, "part").select(_case("p_partkey").alias("case_id")), 0.4).select("case_id", "adjudication", "sponsor_id", F.col("confidence").cast("double").alias("confidence"))


# Names of three persons, the first also as a bad reading; then what is no name: too short, too long, one word, digits.
_NAMES = ("Orikesh Aritari", "Orikesh Antari", "Zevese Quillon", "Mo Brask", "Talvennarix Parquestion", "Miravara", "Zed Qu1llon", "Ulmo Brasker")
_PERSON = (1, 1, 2, 0, 0, 0, 0, 3)


@query("name_outlier_flags", f"""
WITH p AS (SELECT unnest(range({len(_NAMES)})) AS i, unnest({list(_PERSON)}) AS person),
o AS (SELECT 'MIB-' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS case_id, a.person AS intake, b.person AS sponsor, c.person AS third, o_custkey % 3 = 0 AS read FROM orders
  JOIN p a ON a.i = o_orderkey % {len(_NAMES)} JOIN p b ON b.i = o_custkey % {len(_NAMES)} JOIN p c ON c.i = (o_orderkey + o_custkey) % {len(_NAMES)})
SELECT case_id, 'identity_conflict' AS flag FROM o WHERE intake <> 0 AND third <> 0 AND intake <> third AND NOT read
UNION ALL SELECT case_id, 'sponsor_mismatch' FROM o WHERE sponsor <> 0 AND third <> 0 AND sponsor <> third""")
def _(s, sf):
    k, c, n = F.col("o_orderkey"), F.col("o_custkey"), len(_NAMES)
    one = lambda kind, name, source: F.struct(F.lit(kind).alias("document_type"), name.alias("normalized_value"), source.alias("text_source"))
    native = F.lit("native_text")
    # A name that was read off an image is no evidence of a conflict, but confirms.
    names = F.array(one("intake_form", pick(k % n, _NAMES), F.when(c % 3 == 0, "ocr").otherwise(native)), one("sponsor_attestation", pick(c % n, _NAMES), native), one("registry_extract", pick((k + c) % n, _NAMES), F.lit("ocr")))
    # Told apart by the order's key: a written id has room for six digits.
    o = t(s, sf, "orders").select(F.col("o_orderkey").alias("case_id"), F.lit("applicant_name").alias("field"), F.inline(names))
    return predict.name_outliers(o).withColumn("case_id", _case("case_id"))


@query("score_fields", """WITH s AS (SELECT c_custkey, c_custkey % 3 <> 0 AS visa, c_custkey % 5 <> 0 AS fee, c_custkey % 7 <> 0 AS present, c_custkey % 4 = 0 AS lost FROM customer)
SELECT c_custkey AS case_id, CAST(CASE WHEN present AND visa AND NOT lost THEN 5 ELSE 0 END + CASE WHEN present AND fee THEN 4 ELSE 0 END + CASE WHEN present THEN 8 ELSE 0 END AS BIGINT) AS points, CAST(CASE WHEN lost THEN 12 ELSE 17 END AS BIGINT) AS most FROM s""")
def _(s, sf):
    k = F.col("c_custkey")
    pairs = t(s, sf, "customer").select(
        k.alias("case_id"), F.lit("XW-1").alias("truth_visa_class"), F.when(k % 3 == 0, "XW-2").otherwise(" xw-1 ").alias("pred_visa_class"), F.lit("paid").alias("truth_fee_status"), F.when(k % 5 == 0, None).otherwise("PAID").alias("pred_fee_status"),
        F.lit("biohazard_red|active_warrant").alias("truth_risk_flags"), F.lit("active_warrant| biohazard_red").alias("pred_risk_flags"), (k % 7 != 0).alias("present"), F.when(k % 4 == 0, F.array(F.lit("visa_class"))).alias("unrecoverable"),
    )
    scores = evaluate.field_scores(pairs, {f: vocab.FIELD_WEIGHTS[f] for f in ("visa_class", "fee_status", "risk_flags")})
    return scores.groupBy("case_id").agg(F.sum("points").alias("points"), F.sum("max_points").alias("most"))


@query("evaluation_document", f"""WITH {SCORED_SQL}, p AS (SELECT *, CASE WHEN pred IS NULL THEN 0 WHEN truth = pred THEN 8 WHEN truth = 'DENIED' AND pred = 'APPROVED' THEN -4 WHEN pred = 'NEEDS_REVIEW' THEN 2 WHEN truth = 'NEEDS_REVIEW' THEN 1 ELSE 0 END AS pts FROM scored),
s AS (SELECT count(*) AS cases, CAST(sum(pts) AS BIGINT) AS raw_points, count(*) FILTER (pred IS NULL) AS missing, 80 * (CAST(sum(pts) AS DOUBLE) / (count(*) * 8)) AS class_score, least(10.0::DOUBLE, 10 * (count(*) FILTER (pred IS NULL)::DOUBLE / count(*))) AS missing_penalty,
 20 * greatest(0.0::DOUBLE, 1 - 2 * (sum((doc_id % 100 - CASE WHEN truth = pred THEN 100 ELSE 0 END) * (doc_id % 100 - CASE WHEN truth = pred THEN 100 ELSE 0 END)) FILTER (pred IS NOT NULL)::DOUBLE / count(pred) / 10000)) AS calibration FROM p),
c AS (SELECT truth, coalesce(pred, 'MISSING') AS pred, count(*) AS n FROM scored GROUP BY 1, 2), d AS (SELECT string_agg(truth || '/' || pred || '=' || n, ',' ORDER BY truth, pred) AS confusion FROM c)
SELECT cases, raw_points, missing, round(class_score, 6) AS class_score, round(missing_penalty, 6) AS missing_penalty, round(calibration, 6) AS calibration, round(class_score + calibration - missing_penalty, 6) AS total_score, confusion FROM s, d""")
def _(s, sf):
    """The nested document of an evaluation, its parts side by side."""
    x = scored(s, sf)
    d = evaluate.result_document(evaluate.confusion(x), evaluate.sections(x), evaluate.brier(x))
    counts = F.array_join(F.transform("confusion", lambda c: F.concat_ws("", c["truth"], F.lit("/"), c["pred"], F.lit("="), c["n"].cast("string"))), ",")
    return d.select("cases", "raw_points", "missing", *[F.round(c, 6).alias(c) for c in ("class_score", "missing_penalty", "calibration", "total_score")], counts.alias("confusion"))


@query("page_quality_histogram", "SELECT CASE WHEN l_quantity >= 15 AND l_returnflag <> 'R' THEN 'digital_clean' WHEN l_returnflag = 'R' AND l_linenumber > 2 THEN 'scan_readable' WHEN l_returnflag = 'R' THEN 'scan_degraded' ELSE 'insufficient_evidence' END AS quality_class, count(*) AS n FROM lineitem GROUP BY 1")
def _(s, sf):
    q = series.page_quality(F.col("l_quantity"), F.col("l_quantity") * 10, F.col("l_returnflag") == "R", F.col("l_linenumber") * 10.0, F.lit(30.0))
    return t(s, sf, "lineitem").groupBy(q.alias("quality_class")).agg(F.count(F.lit(1)).alias("n"))


@query("fuzzy_labels", f"""SELECT p_partkey, 'MIB-' || lpad(CAST(p_partkey % 1000000 AS VARCHAR), 6, '0') AS case_id, {list(vocab.HOME_WORLDS)}[p_partkey % {len(vocab.HOME_WORLDS)} + 1] AS home_world, {list(vocab.FEE_STATUSES)}[p_partkey % 4 + 1] AS fee_status, {list(vocab.SPECIES)}[p_partkey % {len(vocab.SPECIES)} + 1] AS species_code, {list(vocab.VISA_CLASSES)}[p_size % 5 + 1] AS visa_class FROM part""")
def _(s, sf):
    """Fields behind damaged labels, in texts whose values are known."""
    k = F.col("p_partkey")
    text = F.concat(
        pick(k % 2, ("Case ID: MIB-", "Cese ID MIB-")), F.lpad((k % 1000000).cast("string"), 6, "0"), pick(k % 3, (" Home Workt: ", " Hcme World ", " Home World: ")), pick(k % 13, vocab.HOME_WORLDS), pick(k % 2, (" Foe Status: ", " Fee Statvs ")), pick(k % 4, vocab.FEE_STATUSES),
        F.lit(" Speeies Code "), F.replace(pick(k % len(vocab.SPECIES), vocab.SPECIES), F.lit("_"), F.lit(" ")), F.lit(" Visa Clas: "), pick(F.col("p_size") % 5, vocab.VISA_CLASSES),
    )
    d = t(s, sf, "part").select("p_partkey", text.alias("text"), F.lit("unknown").alias("document_type"), F.create_map().cast("map<string,string>").alias("f"))
    m = labelled.completed(d, found="f")
    return m.select("p_partkey", *[m.f[x].alias(x) for x in ("case_id", "home_world", "fee_status", "species_code", "visa_class")])


@query("near_established_ids")
def _(s, sf):
    """Ids seen once that read like an id seen often in the packet."""
    p = t(s, sf, "lineitem").select(F.col("l_suppkey").alias("packet"), _case("l_partkey").alias("case_id"))
    return identity.near_established(p)


@query("absorbed_outliers", "WITH n AS (SELECT event_id, user_id, value, lag(value) OVER w AS b, lead(value) OVER w AS a FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id, CASE WHEN abs(b - a) <= 5 AND abs(value - b) > 5 AND abs(value - a) > 5 THEN b ELSE value END AS cleaned FROM n")
def _(s, sf):
    return series.absorbed(t(s, sf, "events").select("event_id", "user_id", "value"), ["user_id"], "event_id", "value", 5.0).select("event_id", "cleaned")


@query("cascade_from_anchor", """WITH r AS (SELECT event_id, user_id, value, sum(event_id % 7) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events),
a AS (SELECT user_id, run AS anchor FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1) SELECT event_id, CAST(run - anchor AS BIGINT) AS shift FROM r JOIN a USING (user_id)""")
def _(s, sf):
    e = t(s, sf, "events").select("event_id", "user_id", "value", (F.col("event_id") % 7).alias("step"))
    return series.cascaded(e, ["user_id"], "event_id", "step", "value").select("event_id", "shift")


def _fit_sql(rounds: int = 4) -> str:
    steps = ["f0 AS (SELECT l_returnflag AS g, CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y, false AS done FROM lineitem)"]
    for i in range(rounds):
        steps.append(f"""a{i} AS (SELECT *, regr_slope(y, x) OVER w AS s, regr_intercept(y, x) OVER w AS c FROM f{i} WINDOW w AS (PARTITION BY g)),
b{i} AS (SELECT *, abs(y - (s * x + c)) AS r FROM a{i}), c{i} AS (SELECT *, stddev_pop(r) OVER (PARTITION BY g) AS d FROM b{i}),
d{i} AS (SELECT *, r < 2.5 * d AS k, count(*) OVER (PARTITION BY g) AS n, count(*) FILTER (r < 2.5 * d) OVER (PARTITION BY g) AS m FROM c{i}),
f{i + 1} AS (SELECT g, x, y, done OR coalesce(d < 1e-9, true) OR m < greatest(4, floor(0.3 * n)) AS done FROM d{i} WHERE done OR coalesce(d < 1e-9, true) OR m < greatest(4, floor(0.3 * n)) OR k)""")
    return f"WITH {', '.join(steps)} SELECT g AS l_returnflag, round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 2) AS intercept, count(*) AS n FROM f{rounds} GROUP BY 1"


@query("trimmed_fit", _fit_sql())
def _(s, sf):
    f = series.trimmed_fit(t(s, sf, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return f.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), "n")


@query("phrase_recall", "SELECT doc_id, (CASE WHEN contains(lower(text), 'the') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'license') THEN 1 ELSE 0 END) / CAST(2.0 AS DOUBLE) AS recall FROM documents")
def _(s, sf):
    return t(s, sf, "documents").select("doc_id", series.phrase_recall(F.col("text"), ["the", "License"]).cast("double").alias("recall"))


# Extensions ----------------------------------------------------------------------------------


@query("ext_rollup", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def _(s, sf):
    return t(s, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query("ext_asof", "SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events")
def _(s, sf):
    return t(s, sf, "events").select("event_id", F.lag("event_id").over(W.partitionBy("user_id").orderBy("ts", "event_id")).alias("before"))


@query("ext_window_counts", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(s, sf):
    return arrivals.counts_per_window(t(s, sf, "events"), "ts", "event_type")


@query("page_text_summary", r"SELECT lang, count(*) AS n, CAST(sum(length(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS BIGINT) AS chars FROM documents GROUP BY 1")
def _(s, sf):
    return t(s, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(collapsed(F.col("text")))).alias("chars"))


from . import extended  # noqa: E402, F401  adds its queries to the catalogue
