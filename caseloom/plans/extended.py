"""More of the query catalogue: assignment, checks, errors, trials, regions, images, ordered analytics, sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import normalize, raster, similarity, vocab
from ..operators import check, evaluate, identity, images, observe, pages, series, triage, trials
from ..sources import readers, writers
from ..streaming import arrivals
from .cases import pick, t
from .queries import query

_ID = "'MIB-' || lpad(CAST({} AS VARCHAR), 6, '0')"


def _case(k) -> Column:
    return F.concat(F.lit("MIB-"), F.lpad((F.col(k) if isinstance(k, str) else k).cast("string"), 6, "0"))


# Observations and pages ------------------------------------------------------------------------


@query("assign_pages", f"SELECT CASE WHEN l_linenumber <= 4 AND o_orderstatus <> 'P' THEN {_ID.format('o_custkey')} END AS case_id, count(*) AS n, CAST(sum(l_suppkey) AS BIGINT) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def _(s, sf):
    pages_ = t(s, sf, "orders").select(F.col("o_orderkey").alias("packet"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("page_number"), F.when(F.col("o_orderstatus") != "P", _case("o_custkey")).alias("case_id"))
    o = t(s, sf, "lineitem").select(F.col("l_orderkey").alias("packet"), F.col("l_linenumber").cast("long").alias("page_number"), F.lit("old").alias("case_id"), "l_suppkey")
    return observe.assigned(o, pages_).groupBy("case_id").agg(F.count(F.lit(1)).alias("n"), F.sum("l_suppkey").cast("bigint").alias("s"))


@query("usable_observations", "SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' AND l_tax > 0.02 AND l_returnflag <> 'R' GROUP BY 1")
def _(s, sf):
    o = t(s, sf, "lineitem").select("l_linenumber", F.when(F.col("l_linestatus") == "O", _case("l_orderkey")).alias("case_id"), F.when(F.col("l_tax") > 0.02, "x").alias("normalized_value"), (F.col("l_returnflag") != "R").alias("trusted"))
    return observe.usable(o).groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("expected_case_fallback", f"""WITH p AS (SELECT l_orderkey AS packet, l_linenumber AS page_number, CASE WHEN l_quantity > 30 THEN {_ID.format('l_partkey')} END AS case_id FROM lineitem),
q AS (SELECT p.*, count(case_id) OVER (PARTITION BY packet) AS known, o_orderstatus <> 'P' AS named, o_orderkey FROM p JOIN orders ON packet = o_orderkey)
SELECT packet, CASE WHEN known = 0 AND named THEN {_ID.format('o_orderkey')} ELSE case_id END AS case_id, CASE WHEN known = 0 AND named THEN 'expected_case_fallback' WHEN case_id IS NULL THEN 'none' ELSE 'footer' END AS method, count(*) AS n FROM q GROUP BY ALL""")
def _(s, sf):
    case = F.when(F.col("l_quantity") > 30, _case("l_partkey"))
    p = t(s, sf, "lineitem").select(F.col("l_orderkey").alias("packet"), F.col("l_linenumber").alias("page_number"), case.alias("case_id"), F.when(case.isNull(), "none").otherwise("footer").alias("method"))
    e = t(s, sf, "orders").select(F.col("o_orderkey").alias("packet"), F.when(F.col("o_orderstatus") != "P", _case("o_orderkey")).alias("expected_case_id"))
    return observe.assigned_or_expected(p, e).groupBy("packet", "case_id", "method").agg(F.count(F.lit(1)).alias("n"))


@query("case_id_candidates", f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN {_ID.format('l_orderkey % 1000000')} END AS footer, CASE WHEN l_linenumber % 3 = 0 THEN {_ID.format('l_partkey % 1000000')} END AS header,
 CASE WHEN l_linenumber % 4 = 1 THEN {_ID.format('l_suppkey % 1000000')} END AS internal, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(s, sf):
    n = F.col("l_linenumber")
    damaged = lambda k: F.concat(F.lit("mib-"), F.translate(F.lpad((F.col(k) % 1000000).cast("string"), 6, "0"), "01", "oL"))
    text = F.concat_ws(
        " ", F.when(n % 4 == 1, F.concat(F.lit("Cave 1D; "), damaged("l_suppkey"))).otherwise("Case ID: MIB-12X4Z6"), F.when(n % 3 == 0, F.concat(damaged("l_partkey"), F.lit(" | MIB  Eyes Only"))),
        F.lit("some text"), F.when(n % 2 == 0, F.concat(F.lit("Packet "), damaged("l_orderkey"), F.lit(" /page 3"))).otherwise("Packet MIB-12 / page 3"),
    )
    rows = t(s, sf, "lineitem").select("l_orderkey", "l_linenumber", observe.id_candidates(text).alias("c"))
    return rows.groupBy("l_orderkey", "l_linenumber", "c.footer", "c.header", "c.internal").agg(F.count(F.lit(1)).alias("n"))


@query("file_case_ids", f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN {_ID.format('o_orderkey % 1000000')} END AS case_id FROM orders")
def _(s, sf):
    k = F.col("o_orderkey")
    path = F.concat(F.lit("/in/MIB-999999/copy_"), F.when(k % 5 == 0, "none").otherwise(F.lower(_case(k % 1000000))), F.lit("(2).PDF"))
    return t(s, sf, "orders").select("o_orderkey", observe.file_case_id(path).alias("case_id"))


@query("read_again", """SELECT CAST((l_tax > 0.04)::INT + (l_discount > 0.05)::INT AS INT) AS fields, l_linenumber = 3 OR (l_tax <= 0.04 AND l_discount <= 0.05) OR (l_returnflag <> 'N' AND l_quantity < 35) AS again, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(s, sf):
    fields = F.create_map(F.lit("a"), F.when(F.col("l_tax") > 0.04, "x").otherwise(" \t"), F.lit("b"), F.when(F.col("l_discount") > 0.05, "y"))
    rows = t(s, sf, "lineitem").withColumn("f", fields)
    again = observe.read_again(F.when(F.col("l_linenumber") == 3, "unknown").otherwise("fee_receipt"), F.col("f"), F.when(F.col("l_returnflag") != "N", F.col("l_quantity")))
    return rows.select(observe.field_count(F.col("f")).alias("fields"), again.alias("again")).groupBy("fields", "again").agg(F.count(F.lit(1)).alias("n"))


@query("plausible_names", r"SELECT n_name || ' ' || r_name AS name, regexp_full_match(n_name || ' ' || r_name, '[A-Za-z\-]+ [A-Za-z\-]+') AND length(n_name || ' ' || r_name) BETWEEN 10 AND 18 AS plausible, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def _(s, sf):
    n = t(s, sf, "nation").join(F.broadcast(t(s, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.concat_ws(" ", "n_name", "r_name").alias("name"))
    rows = t(s, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("name", observe.plausible_name(F.col("name")).alias("plausible")).agg(F.count(F.lit(1)).alias("n"))


@query("fill_missing_fields", """SELECT l_orderkey, CASE WHEN l_tax > 0.04 THEN 'kept' ELSE 'SPN-' || l_suppkey END AS sponsor, CASE WHEN l_quantity > 25 THEN 'Orikesh Antari' ELSE 'Zevese Quillon' END AS applicant, 'old' AS other, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(s, sf):
    fields = F.create_map(F.lit("sponsor_id"), F.when(F.col("l_tax") > 0.04, "kept").otherwise(""), F.lit("applicant"), F.when(F.col("l_quantity") > 25, "Orikesh Antari").otherwise("Orin"), F.lit("other"), F.lit("old"))
    again = F.create_map(F.lit("sponsor_id"), F.concat(F.lit("SPN-"), F.col("l_suppkey").cast("string")), F.lit("applicant"), F.lit("Zevese Quillon"), F.lit("other"), F.lit("new"))
    m = t(s, sf, "lineitem").select("l_orderkey", observe.filled(fields, again, ["sponsor_id", "applicant"]).alias("f"))
    return m.groupBy("l_orderkey", m.f["sponsor_id"].alias("sponsor"), m.f["applicant"].alias("applicant"), m.f["other"].alias("other")).agg(F.count(F.lit(1)).alias("n"))


_ROUTE = {"usable": "l_linenumber = 1", "suspicious": "l_returnflag = 'R'", "scan_readable": "l_linenumber = 2", "scan_degraded": "l_linenumber = 3", "mixed_content": "l_linenumber = 4"}


def _route_sql() -> str:
    name = "CASE " + " ".join(f"WHEN {test} THEN '{n}'" for n, test in _ROUTE.items()) + " ELSE 'otherwise' END"
    cell = lambda v: v if isinstance(v, str) and v.startswith("low_") else f"'{v}'" if isinstance(v, str) else str(v).lower()
    columns = ", ".join("CASE r " + " ".join(f"WHEN '{n}' THEN {cell(row[i])}" for n, row in pages.ROUTES.items()) + f" END AS {c}" for i, c in enumerate(pages.ROUTE_COLUMNS))
    reason = "CASE r " + " ".join(f"WHEN '{n}' THEN '{text}'" for n, text in pages.REASONS.items()) + " END AS reason"
    return f"WITH q AS (SELECT {name} AS r, l_tax > 0.04 AS low_contrast, l_discount > 0.05 AS low_sharpness FROM lineitem), x AS (SELECT {columns}, {reason} FROM q) SELECT *, CASE WHEN enhance_contrast THEN 'degraded_scan' ELSE 'standard' END AS profile, count(*) AS n FROM x GROUP BY ALL"


@query("route_columns", _route_sql())
def _(s, sf):
    quality = pick(F.col("l_linenumber") % 5, ("insufficient_evidence", "digital_clean", "scan_readable", "scan_degraded", "mixed_content"))
    quality = F.when(F.col("l_linenumber").isin(2, 3, 4), quality).otherwise("insufficient_evidence")
    r = pages.route(F.col("l_linenumber") == 1, F.col("l_returnflag") == "R", quality, F.col("l_tax") > 0.04, F.col("l_discount") > 0.05)
    rows = t(s, sf, "lineitem").select(r.alias("r")).select("r.*").withColumn("profile", images.profile(F.col("enhance_contrast"))["name"])
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


# Checks and errors -----------------------------------------------------------------------------


@query("row_messages", f"""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 1 THEN 'missing: home_world' WHEN 2 THEN 'unexpected: aa,zz' WHEN 3 THEN 'invalid case_id: ' || o_orderkey WHEN 4 THEN 'confidence is no number' WHEN 5 THEN 'invalid arrival_date: 2026-02-30;confidence out of range'
 WHEN 6 THEN 'fee_status is no string;invalid adjudication: ' || o_orderstatus WHEN 7 THEN 'missing: confidence;unexpected: zz' ELSE '' END AS messages FROM orders""")
def _(s, sf):
    k = F.col("o_orderkey") % 8
    fields = {"case_id": F.when(k == 3, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit(" "), _case(F.col("o_orderkey") % 1000000))), "sponsor_id": F.lit("SPN-0001"), "arrival_date": F.when(k == 5, "2026-02-30").otherwise("2026-02-28"), "fee_status": F.when(k != 6, "paid"), "adjudication": F.when(k == 6, F.col("o_orderstatus")).otherwise("DENIED"), "confidence": F.when(k == 5, "1.5").otherwise("0.5")}
    row = F.create_map(*[x for f in check.FIELDS for x in (F.lit(f), fields.get(f, F.lit("")))])
    gone = F.when(k == 1, "home_world").when(k == 7, "confidence").otherwise("")
    more = F.when(k == 2, F.create_map(F.lit("zz"), F.lit("1"), F.lit("aa"), F.lit("2"))).when(k == 7, F.create_map(F.lit("zz"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>"))
    row = F.map_concat(F.map_filter(row, lambda f, v: f != gone), more)
    kinds = F.create_map(*[x for f in check.FIELDS for x in (F.lit(f), F.when((k == 6) & F.lit(f == "fee_status"), "null").when(F.lit(f == "confidence") & (k != 4), "number").otherwise("string"))])
    return t(s, sf, "orders").select("o_orderkey", F.array_join(check.row_messages(row, kinds), ";").alias("messages"))


@query("unknown_labels", f"SELECT {_ID.format('o_orderkey')} AS case_id, o_orderstatus AS field, 'recoverable' AS label, 'maybe' AS value FROM orders WHERE o_orderkey % 4 = 1 UNION ALL SELECT {_ID.format('o_orderkey')}, o_orderstatus, 'fix_priority', o_orderstatus FROM orders WHERE o_orderkey % 3 = 2")
def _(s, sf):
    k = F.col("o_orderkey")
    rows = t(s, sf, "orders").select(_case("o_orderkey").alias("case_id"), F.col("o_orderstatus").alias("field"), pick(k % 3, ("ocr_layout", " ", None)).alias("root_cause"), pick(k % 4, ("yes", "maybe", " no ", None)).alias("recoverable"), F.when(k % 3 == 2, F.col("o_orderstatus")).otherwise("now").alias("fix_priority"))
    return check.unknown_labels(rows)


@query("select_fields", f"SELECT {_ID.format('l_orderkey')} AS case_id, l_returnflag AS field, l_extendedprice FROM lineitem WHERE l_returnflag IN ('A', 'N') ORDER BY l_extendedprice, l_orderkey LIMIT 20")
def _(s, sf):
    rows = t(s, sf, "lineitem").select(_case("l_orderkey").alias("case_id"), F.col("l_returnflag").alias("field"), "l_extendedprice", F.struct("l_extendedprice", "l_orderkey").alias("path"))
    return check.selected(rows, fields=" A,N ,", limit=20).drop("path")


@query("parsed_values", "SELECT l_linenumber, l_linenumber IN (1, 3) AS flag, CASE WHEN l_returnflag = 'R' THEN 7 ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS whole, count(*) AS n FROM lineitem GROUP BY ALL")
def _(s, sf):
    written = pick(F.col("l_linenumber") % 8, ("0", " TRUE", "no", "yes", "y", "", "2", None))
    number = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_extendedprice").cast("string"))
    return t(s, sf, "lineitem").groupBy("l_linenumber", check.flag(written).alias("flag"), check.whole(number, 7).cast("bigint").alias("whole")).agg(F.count(F.lit(1)).alias("n"))


@query("error_rows", f"""WITH x AS (SELECT {_ID.format('o_orderkey')} AS case_id, o_orderkey, o_custkey % 4 AS c FROM orders),
r AS (SELECT case_id, o_orderkey, 'risk_flags' AS field, CASE c WHEN 0 THEN 'a|b' WHEN 1 THEN 'a' WHEN 2 THEN NULL ELSE 'b' END AS e, 'a|b' AS p, 'corroborated' AS status FROM x
 UNION ALL SELECT case_id, o_orderkey, 'visa_class', 'XW-1', CASE c WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'xw-1' ELSE NULL END, CASE c WHEN 0 THEN 'missing' WHEN 1 THEN 'conflicting' WHEN 2 THEN 'single_source' ELSE NULL END FROM x),
o AS (SELECT l_orderkey, to_json(list(struct_pack(page := l_linenumber, document_type := 'fee_receipt', text_source := CAST(NULL AS VARCHAR), raw_value := CAST(l_suppkey AS VARCHAR), normalized_value := l_returnflag) ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR), l_returnflag)) AS seen FROM lineitem GROUP BY 1)
SELECT case_id, field, e AS expected_value, p AS predicted_value, CASE WHEN status IS NULL THEN 'field_not_extracted' WHEN status = 'missing' THEN 'missing_value' WHEN status = 'conflicting' THEN 'corroboration_conflict' WHEN p IS NULL THEN 'normalization_returned_none' WHEN e IS NULL THEN 'unexpected_prediction' ELSE 'incorrect_value' END AS error_category,
 coalesce(status, 'field_absent') AS resolution_status, CASE WHEN field = 'visa_class' THEN coalesce(CAST(seen AS VARCHAR), '[]') ELSE '[]' END AS all_observations FROM r LEFT JOIN o ON o_orderkey = l_orderkey WHERE e IS DISTINCT FROM p""")
def _(s, sf):
    c = F.col("o_custkey") % 4
    # Told apart by the order's key: a written id has room for six digits.
    base = t(s, sf, "orders").select(F.col("o_orderkey").alias("case_id"), c.alias("c"))
    expected = base.select("case_id", F.inline(F.array(F.struct(F.lit("risk_flags").alias("field"), pick(F.col("c"), ("b| a", "a||a ", " ", "b")).alias("value")), F.struct(F.lit("visa_class").alias("field"), F.lit(" XW-1 ").alias("value")))))
    resolved = base.select("case_id", F.inline(F.array(
        F.struct(F.lit("risk_flags").alias("field"), F.lit("b|a|b").alias("resolved_value"), F.lit("corroborated").alias("status"), F.lit("exact_match").alias("resolution_method")),
        F.struct(F.when(F.col("c") < 3, "visa_class").otherwise("other").alias("field"), F.when(F.col("c") == 2, "xw-1").alias("resolved_value"), pick(F.col("c"), ("missing", "conflicting", "single_source", "x")).alias("status"), F.lit("m").alias("resolution_method")),
    )))
    seen = t(s, sf, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.lit("visa_class").alias("field"), F.col("l_linenumber").alias("page_number"), F.lit("fee_receipt").alias("document_type"), F.lit(None).cast("string").alias("text_source"), F.col("l_suppkey").cast("string").alias("raw_value"), F.col("l_returnflag").alias("normalized_value"))
    return check.error_rows(expected, resolved, seen).drop("resolution_method").withColumn("case_id", _case("case_id"))


@query("case_scores", """WITH c AS (SELECT *, c_custkey % 7 <> 0 AS here, ['APPROVED', 'DENIED', 'NEEDS_REVIEW'][c_custkey % 3 + 1] AS t, ['APPROVED', 'DENIED', 'NEEDS_REVIEW', 'maybe', 'APPROVED'][c_custkey % 5 + 1] AS p, CASE c_custkey % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 END AS conf FROM customer)
SELECT c_custkey AS case_id, CASE WHEN here THEN upper(p) ELSE 'MISSING' END AS pred_adjudication, CAST(CASE WHEN NOT here THEN 0 ELSE CASE WHEN c_nationkey % 2 = 0 THEN 0 ELSE 5 END + CASE WHEN c_custkey % 2 = 0 THEN 8 ELSE 0 END END AS BIGINT) AS extraction_raw, CAST(CASE WHEN c_nationkey % 2 = 0 THEN 8 ELSE 13 END AS BIGINT) AS extraction_max_raw,
 CASE WHEN NOT here OR p = 'maybe' THEN 0 WHEN t = p THEN 8 WHEN t = 'DENIED' AND p = 'APPROVED' THEN -4 WHEN p = 'NEEDS_REVIEW' THEN 2 WHEN t = 'NEEDS_REVIEW' THEN 1 ELSE 0 END AS classification_raw,
 CASE WHEN NOT here THEN 'missing_case' WHEN p = 'maybe' THEN 'invalid_or_blank' WHEN t = p THEN 'correct' WHEN t = 'DENIED' AND p = 'APPROVED' THEN 'catastrophic_false_approval' WHEN p = 'NEEDS_REVIEW' THEN 'conservative_review' WHEN t = 'NEEDS_REVIEW' THEN 'missed_review' ELSE 'wrong_decision' END AS classification_reason,
 CASE WHEN here THEN p <> 'maybe' END AS adjudication_valid, CASE WHEN here THEN coalesce(CAST(conf AS DOUBLE), 0.0) END AS confidence, CASE WHEN here THEN conf IS NOT NULL END AS confidence_valid,
 CASE WHEN here THEN CASE WHEN conf IS NULL THEN 1.0 ELSE CAST((conf - CASE WHEN t = p THEN 1 ELSE 0 END) * (conf - CASE WHEN t = p THEN 1 ELSE 0 END) AS DOUBLE) END END AS confidence_brier, CASE WHEN here THEN c_custkey % 2 = 0 END AS fee_status_valid, c_custkey % 3 = 1 AS traps_present FROM c""")
def _(s, sf):
    k = F.col("c_custkey")
    pairs = t(s, sf, "customer").select(
        k.alias("case_id"), (k % 7 != 0).alias("present"), pick(k % 3, ("approved ", "DENIED", "Needs_Review")).alias("truth_adjudication"), pick(k % 5, ("APPROVED", "denied", "NEEDS_REVIEW", "maybe", "approved")).alias("pred_adjudication"), pick(k % 4, ("0.5", "0", "1", "1.01")).alias("pred_confidence"),
        F.when(F.col("c_nationkey") % 2 == 0, "Visa_Class| none").otherwise(" NONE ").alias("unrecoverable"), pick(k % 3, ("none", "decoy|decoy", "")).alias("traps"), F.lit("XW-1").alias("truth_visa_class"), F.lit("xw-1").alias("pred_visa_class"),
        F.lit("b|a").alias("truth_risk_flags"), F.when(k % 2 == 0, " a | B").otherwise("a").alias("pred_risk_flags"), F.when(k % 2 == 0, "paid").otherwise("PAID").alias("pred_fee_status"),
    )
    c = evaluate.case_scores(pairs, {"visa_class": 5, "risk_flags": 8})
    return c.select("case_id", "pred_adjudication", "extraction_raw", "extraction_max_raw", "classification_raw", "classification_reason", "adjudication_valid", "confidence", "confidence_valid", "confidence_brier", "fee_status_valid", "traps_present")


@query("first_samples", "SELECT event_type, count(user_id) AS n, array_to_string(list_sort(list_distinct(list(user_id)))[1:20], ',') AS first FROM events GROUP BY 1")
def _(s, sf):
    return evaluate.samples(t(s, sf, "events"), ["event_type"], "user_id", 20).select("event_type", "n", F.array_join(F.col("first").cast("array<string>"), ",").alias("first"))


@query("label_summary", """WITH r AS (SELECT CASE l_linenumber WHEN 1 THEN 'regex' WHEN 2 THEN 'ocr_layout' WHEN 3 THEN 'policy' WHEN 4 THEN '  ' ELSE 'other' END AS root_cause, l_linenumber AS weight FROM lineitem)
SELECT root_cause, count(*) AS errors, CAST(sum(weight) AS BIGINT) AS weighted, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS errors_percent, round(sum(weight) * 100.0::DOUBLE / sum(sum(weight)) OVER (), 2) AS weighted_percent FROM r WHERE trim(root_cause) <> '' GROUP BY 1""")
def _(s, sf):
    n = F.col("l_linenumber")
    return triage.label_summary(t(s, sf, "lineitem").select(F.when(n == 1, "regex").when(n == 2, "ocr_layout").when(n == 3, "policy").when(n == 4, "  ").otherwise("other").alias("root_cause"), n.alias("weight")), "root_cause")


_FLAGS = """f AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'APPROVED' WHEN o_orderstatus = 'F' THEN 'DENIED' ELSE 'NEEDS_REVIEW' END AS adjudication, unnest(list_filter([CASE WHEN o_custkey % 2 = 0 THEN 'identity_conflict' END, CASE WHEN o_custkey % 3 = 0 THEN 'sponsor_mismatch' END, CASE WHEN o_custkey % 5 = 0 THEN 'illegible_biometrics' END, CASE WHEN o_custkey % 7 = 0 THEN 'biohazard_red' END], lambda x: x IS NOT NULL)) AS risk_flags FROM orders)"""


def _flagged(s, sf) -> DataFrame:
    c = F.col("o_custkey")
    flags = F.concat_ws("|", F.lit("none"), *[F.when(c % n == 0, name) for n, name in ((2, " identity_conflict"), (3, "sponsor_mismatch"), (5, "illegible_biometrics "), (7, "biohazard_red"))])
    decision = F.when(F.col("o_orderstatus") == "O", "APPROVED").when(F.col("o_orderstatus") == "F", "DENIED").otherwise("NEEDS_REVIEW")
    # Told apart by the order's key: a written id has room for six digits.
    return triage.flag_rows(t(s, sf, "orders").select(F.col("o_orderkey").alias("case_id"), decision.alias("adjudication"), flags.alias("risk_flags")))


@query("flag_rows", f"WITH {_FLAGS} SELECT {_ID.format('o_orderkey')} AS case_id, risk_flags FROM f")
def _(s, sf):
    return _flagged(s, sf).select(_case("case_id").alias("case_id"), "risk_flags")


@query("flag_decisions", f"WITH {_FLAGS} SELECT risk_flags, count(*) FILTER (adjudication = 'APPROVED') AS APPROVED, count(*) FILTER (adjudication = 'DENIED') AS DENIED, count(*) FILTER (adjudication = 'NEEDS_REVIEW') AS NEEDS_REVIEW FROM f GROUP BY 1")
def _(s, sf):
    return triage.crosstab(_flagged(s, sf), "risk_flags", "adjudication", list(vocab.DECISIONS))


@query("flag_combinations", f"WITH {_FLAGS}, c AS (SELECT o_orderkey, adjudication, string_agg(risk_flags, '|' ORDER BY risk_flags) AS combination, count(*) AS k FROM f WHERE risk_flags <> 'biohazard_red' GROUP BY 1, 2) SELECT combination, count(*) FILTER (adjudication = 'APPROVED') AS APPROVED, count(*) FILTER (adjudication = 'DENIED') AS DENIED, count(*) FILTER (adjudication = 'NEEDS_REVIEW') AS NEEDS_REVIEW FROM c WHERE k >= 2 GROUP BY 1")
def _(s, sf):
    return triage.flag_combinations(_flagged(s, sf), vocab.REVIEW_ONLY)


@query("lines_by_top", "SELECT conv_id, array_to_string(list(role || ':' || turn ORDER BY turn % 3, turn, role || ':' || turn), ' ') AS lines FROM conversations GROUP BY 1")
def _(s, sf):
    rows = t(s, sf, "conversations").select("conv_id", (F.col("turn") % 3).alias("top"), F.col("turn").alias("left"), F.concat_ws(":", "role", F.col("turn").cast("string")).alias("text"))
    return triage.lines_by_top(rows, ["conv_id"]).select("conv_id", F.array_join("lines", " ").alias("lines"))


# Trials, regions, images ----------------------------------------------------------------------


def _grid_sql() -> str:
    value = lambda v: f"'{v}'" if isinstance(v, str) else str(v).lower()
    return "SELECT * FROM " + ", ".join(f"(VALUES {', '.join(f'({value(v)})' for v in values)}) {name}_({name})" for name, values in trials.GRID.items())


@query("trial_grid", _grid_sql().replace("1.0", "1.0::DOUBLE").replace("(1.5)", "(1.5::DOUBLE)").replace("(2.0)", "(2.0::DOUBLE)"))
def _(s, sf):
    return trials.grid(s)


@query("trial_phrases", "WITH p AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS t FROM documents) SELECT doc_id, (contains(t, 'the')::INT + contains(t, 'of the')::INT + contains(t, 'http')::INT) / 3.0::DOUBLE AS share, concat_ws(',', CASE WHEN contains(t, 'the') THEN 'THE' END, CASE WHEN contains(t, 'of the') THEN 'of, the!' END, CASE WHEN contains(t, 'http') THEN 'http' END) AS found FROM p WHERE t IS NOT NULL")
def _(s, sf):
    d = t(s, sf, "documents").where("text IS NOT NULL").select("doc_id", trials.phrases_found(F.col("text"), F.array(F.lit("THE"), F.lit("of, the!"), F.lit("http"))).alias("p"))
    return d.select("doc_id", "p.share", F.array_join("p.found", ",").alias("found"))


@query("trial_values")
def _(s, sf):
    """Names of nations in badly read lines, a line per customer; similarity has no SQL counterpart, see the tests."""
    n = F.broadcast(t(s, sf, "nation").select("n_nationkey", "n_name"))
    rows = t(s, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    read = F.when(k % 3 == 0, F.col("n_name")).when(k % 3 == 1, F.translate("n_name", "IO", "l0")).otherwise(F.reverse("n_name"))
    return trials.recovery(trials.values_found(rows.select(k.alias("text_id"), F.concat(F.lit("Home of the client: "), read, F.lit(", by its own account")).alias("text"), F.lit("nation").alias("field"), F.col("n_name").alias("value"))))


@query("ranked_trials", "SELECT p_partkey, p_size / 50.0::DOUBLE AS combined_score, row_number() OVER (ORDER BY p_size DESC, p_partkey % 7 DESC, p_partkey % 5 DESC, p_partkey) AS rank FROM part ORDER BY p_size DESC, p_partkey % 7 DESC, p_partkey % 5 DESC, p_partkey LIMIT 10")
def _(s, sf):
    k = F.col("p_partkey")
    r = t(s, sf, "part").select("p_partkey", (F.col("p_size") / 50.0).alias("combined_score"), (k % 7).alias("value_score"), (k % 5).alias("exact"), k.cast("double").alias("seconds"))
    return trials.ranked(r).select("p_partkey", "combined_score", F.col("rank").cast("bigint").alias("rank"))


@query("region_pixels", "SELECT p_partkey, greatest(0, CAST(floor(p_size / 100.0::DOUBLE * 1700) AS INT) - 10) AS x1, greatest(0, CAST(floor(0.0 * 2200) AS INT) - 10) AS y1, least(1700, CAST(floor((p_size + 50) / 100.0::DOUBLE * 1700) AS INT) + 10) AS x2, least(2200, CAST(floor(p_size / 50.0::DOUBLE * 2200) AS INT) + 10) AS y2 FROM part")
def _(s, sf):
    z = F.col("p_size")
    region = F.struct((z / 100.0).alias("x1"), F.lit(0.0).alias("y1"), ((z + 50) / 100.0).alias("x2"), (z / 50.0).alias("y2"))
    return t(s, sf, "part").select("p_partkey", trials.pixels(region, F.lit(1700), F.lit(2200), 10).alias("b")).select("p_partkey", "b.*")


@query("region_values", """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'SPN-' || o_custkey WHEN 1 THEN '2026-0' || (o_custkey % 9 + 1) || '-05' WHEN 2 THEN '2026-11-1' || (o_custkey % 10) WHEN 3 THEN 'DENIED' WHEN 4 THEN 'unpaid' WHEN 5 THEN 'WAIT ' || o_custkey ELSE 'some text ' || o_custkey END AS v FROM orders""")
def _(s, sf):
    k, c = F.col("o_orderkey") % 7, F.col("o_custkey").cast("string")
    field = pick(k, ("sponsor_id", "arrival_date", "arrival_date", "decision", "fee_status", "decision", "applicant"))
    digit = lambda n, plus=0: (F.col("o_custkey") % n + plus).cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit(" spn - "), c)).when(k == 1, F.concat(F.lit("on 2026 / "), digit(9, 1), F.lit(". 5"))).when(k == 2, F.concat(F.lit("2026x11y1"), digit(10))).when(k == 3, F.lit(" d-e-n i e d!"))
        .when(k == 4, F.lit("UN PAID, paid")).when(k == 5, F.concat(F.lit(" wait  "), c)).otherwise(F.concat(F.lit(" some\ntext  "), c))
    )
    return t(s, sf, "orders").select("o_orderkey", trials.region_value(field, text).alias("v"))


#: Images of 12 rows by 16 columns that SQL can repeat: pixel (y, x) of a part.
_PIXEL = "(p_partkey * 7 + y * 13 + x * x * 5) % 256"


def _pictures(s, sf) -> DataFrame:
    levels = F.transform(F.sequence(F.lit(0), F.lit(191)), lambda i: (F.col("p_partkey") * 7 + F.floor(i / 16) * 13 + (i % 16) * (i % 16) * 5) % 256)
    pixels = F.unhex(F.array_join(F.transform(levels, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))
    return t(s, sf, "part").select("p_partkey", F.struct(F.lit(12).alias("height"), F.lit(16).alias("width"), F.lit(1).alias("channels"), pixels.alias("pixels")).alias("image"))


_PICTURES_SQL = f"px AS (SELECT p_partkey, y, x, {_PIXEL} AS v FROM part, range(12) a(y), range(16) b(x))"


@query("image_measures", f"""WITH {_PICTURES_SQL}, d AS (SELECT p_partkey, v, (lead(v) OVER (PARTITION BY p_partkey, y ORDER BY x) - v + 256) % 256 AS h, (lead(v) OVER (PARTITION BY p_partkey, x ORDER BY y) - v + 256) % 256 AS w FROM px)
SELECT p_partkey, round(stddev_pop(v), 6) AS contrast, round(var_pop(h) + var_pop(w), 4) AS sharpness FROM d GROUP BY 1""")
def _(s, sf):
    p = _pictures(s, sf)
    return p.select("p_partkey", F.round(images.measured(F.col("image"), raster.contrast, "double"), 6).alias("contrast"), F.round(images.measured(F.col("image"), raster.sharpness, "double"), 4).alias("sharpness"))


def _place_sum(a) -> int:
    import numpy as np

    return int((a.astype(np.int64).ravel() * np.arange(1, a.size + 1)).sum())


def _crop(a):
    return images.cropped(a, (2, 1, 9, 8))


@query("image_turned_and_cropped", f"WITH {_PICTURES_SQL} SELECT p_partkey, CAST(sum(v * (x * 12 + (11 - y) + 1)) AS BIGINT) AS turned, CAST(sum(CASE WHEN x BETWEEN 2 AND 8 AND y BETWEEN 1 AND 7 THEN v * ((y - 1) * 7 + x - 2 + 1) ELSE 0 END) AS BIGINT) AS cropped, CAST(sum((255 - v) * (y * 16 + x + 1)) AS BIGINT) AS inverted, CAST(sum(CASE WHEN v >= 195 THEN 255 ELSE v END * (y * 16 + x + 1)) AS BIGINT) AS clean FROM px GROUP BY 1")
def _(s, sf):
    i = F.col("image")
    p = _pictures(s, sf).select("p_partkey", images.rotated(i, 90).alias("a"), images.changed(i, _crop).alias("b"), images.changed(i, raster.inverted).alias("c"), images.changed(i, raster.without_faint).alias("d"))
    sums = {"turned": "a", "cropped": "b", "inverted": "c", "clean": "d"}
    return p.select("p_partkey", *[images.measured(F.col(c), _place_sum, "bigint").alias(name) for name, c in sums.items()])


@query("image_otsu", f"""WITH {_PICTURES_SQL}, h AS (SELECT p_partkey, v AS level, count(*) AS n FROM px GROUP BY 1, 2), c AS (SELECT p_partkey, level, sum(n) OVER w AS below, sum(n * level) OVER w AS weight, sum(n) OVER (PARTITION BY p_partkey) AS total, sum(n * level) OVER (PARTITION BY p_partkey) AS whole FROM h WINDOW w AS (PARTITION BY p_partkey ORDER BY level)),
s AS (SELECT p_partkey, level, below * (total - below) * (weight::DOUBLE / below - (whole - weight)::DOUBLE / (total - below)) * (weight::DOUBLE / below - (whole - weight)::DOUBLE / (total - below)) AS spread FROM c WHERE below < total),
b AS (SELECT p_partkey, level FROM s QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY spread DESC, level) = 1) SELECT p_partkey, CAST(any_value(level) AS INT) AS otsu, CAST(sum(CASE WHEN v > level THEN 255 * (y * 16 + x + 1) ELSE 0 END) AS BIGINT) AS black_white FROM px JOIN b USING (p_partkey) GROUP BY 1""")
def _(s, sf):
    i = F.col("image")
    return _pictures(s, sf).select("p_partkey", images.measured(i, raster.otsu, "int").alias("otsu"), images.measured(images.changed(i, raster.thresholded, "otsu"), _place_sum, "bigint").alias("black_white"))


@query("image_thresholds")
def _(s, sf):
    """Levels of black and white of the pictures; filters around each pixel are tested against plain loops."""
    i = F.col("image")
    p = _pictures(s, sf)
    return p.select("p_partkey", images.measured(i, raster.otsu, "int").alias("otsu"), *[images.measured(images.changed(i, raster.thresholded, m), _place_sum, "bigint").alias(m) for m in ("otsu", "adaptive_mean", "adaptive_gaussian")][1:], images.measured(images.changed(i, raster.equalized), _place_sum, "bigint").alias("equalized"))


@query("image_coverage", """WITH p AS (SELECT DISTINCT l_orderkey, l_partkey % 5 AS image_id, round(CAST(l_discount * 100 AS DOUBLE), 2) AS x0, 0.0::DOUBLE AS y0, round(CAST(l_quantity AS DOUBLE), 2) AS x1, round(CAST(l_tax * 1000 AS DOUBLE), 2) AS y1 FROM lineitem)
SELECT l_orderkey, count(DISTINCT image_id) AS images, round(max(least(1.0::DOUBLE, greatest(0, x1 - x0) * greatest(0, y1 - y0) / 2000.0)), 9) AS coverage FROM p GROUP BY 1""")
def _(s, sf):
    li = t(s, sf, "lineitem")
    p = li.select("l_orderkey", (F.col("l_partkey") % 5).alias("image_id"), (F.col("l_discount") * 100).cast("double").alias("x0"), F.lit(0.0).alias("y0"), F.col("l_quantity").cast("double").alias("x1"), (F.col("l_tax") * 1000).cast("double").alias("y1"))
    c = images.image_coverage(p, F.lit(50.0), F.lit(40.0), ["l_orderkey"])
    return c.select("l_orderkey", "images", F.round("coverage", 9).alias("coverage"))


@query("words_read", "SELECT l_orderkey, array_to_string(list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) FILTER (l_linenumber <> 2), ' ') AS text, sum(CASE WHEN l_linenumber <> 2 AND l_quantity >= 10 THEN CAST(l_quantity AS INT) END) / count(CASE WHEN l_linenumber <> 2 AND l_quantity >= 10 THEN 1 END) AS confidence, CAST(count(CASE WHEN l_linenumber <> 2 THEN 1 END) AS INT) AS words FROM lineitem GROUP BY 1")
def _(s, sf):
    n = F.col("l_linenumber")
    w = F.struct(n, "l_partkey", "l_suppkey", F.when(n == 2, "  ").otherwise(F.concat(F.lit(" "), "l_returnflag")).alias("text"), F.when(F.col("l_quantity") >= 10, F.col("l_quantity").cast("int")).otherwise(-1).cast("string").alias("confidence"))
    rows = t(s, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(w)).alias("w"))
    r = rows.select("l_orderkey", images.words_read(F.transform("w", lambda x: F.struct(x["text"].alias("text"), x["confidence"].alias("confidence")))).alias("r")).select("l_orderkey", "r.*")
    return r.select("l_orderkey", F.nullif("text", F.lit("")).alias("text"), "confidence", "words")


# Ordered analytics -----------------------------------------------------------------------------


@query("robust_median", "WITH m AS (SELECT l_orderkey, median(CAST(l_quantity AS DOUBLE)) AS m FROM lineitem GROUP BY 1), a AS (SELECT l.l_orderkey, CAST(l_quantity AS DOUBLE) AS v, m, abs(CAST(l_quantity AS DOUBLE) - m) AS a FROM lineitem l JOIN m USING (l_orderkey)), d AS (SELECT l_orderkey, median(a) + 1e-6 AS mad FROM a GROUP BY 1) SELECT l_orderkey, coalesce(median(CASE WHEN a < 1.5 * mad THEN v END), any_value(m)) AS median FROM a JOIN d USING (l_orderkey) GROUP BY 1")
def _(s, sf):
    return series.robust_median(t(s, sf, "lineitem").select("l_orderkey", "l_quantity"), ["l_orderkey"], "l_quantity", 1.5)


@query("darkest_rows", "WITH p AS (SELECT l_orderkey, quantile_cont(CAST(l_quantity AS DOUBLE), 0.55) AS q FROM lineitem GROUP BY 1), d AS (SELECT l.l_orderkey, CAST(l_quantity AS DOUBLE) <= q AS dark, count(*) FILTER (CAST(l_quantity AS DOUBLE) <= q) OVER (PARTITION BY l.l_orderkey) AS k FROM lineitem l JOIN p USING (l_orderkey)) SELECT l_orderkey, count(*) AS n FROM d WHERE k < 3 OR dark GROUP BY 1")
def _(s, sf):
    return series.darkest(t(s, sf, "lineitem").select("l_orderkey", F.col("l_quantity").cast("double").alias("l_quantity")), ["l_orderkey"], "l_quantity").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("continuity_filter", "WITH v AS (SELECT event_id, user_id, CASE WHEN event_id % 5 <> 0 THEN value END AS v FROM events), n AS (SELECT *, list_filter(list(v) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING), lambda x: x IS NOT NULL) AS near FROM v) SELECT event_id, CASE WHEN len(near) > 0 AND len(list_filter(near, lambda x: abs(x - v) <= 6)) / len(near) >= 0.5 THEN v END AS kept FROM n")
def _(s, sf):
    e = t(s, sf, "events").select("event_id", "user_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("v"))
    return series.continuous(e, ["user_id"], "event_id", "v").select("event_id", "kept")


@query("quality_summary", "WITH p AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'scan_degraded' WHEN 'A' THEN 'digital_clean' ELSE 'mixed_content' END AS q, l_returnflag = 'R' AS o, l_linestatus = 'F' AS s FROM lineitem), c AS (SELECT l_orderkey, q, count(*) AS n FROM p GROUP BY 1, 2), d AS (SELECT l_orderkey, string_agg(q || '=' || n, ',' ORDER BY q) AS counts FROM c GROUP BY 1) SELECT l_orderkey, counts, array_to_string(coalesce(list(l_linenumber ORDER BY l_linenumber) FILTER (o), []), ',') AS ocr, array_to_string(coalesce(list(l_linenumber ORDER BY l_linenumber) FILTER (s), []), ',') AS suspicious FROM p JOIN d USING (l_orderkey) GROUP BY 1, 2")
def _(s, sf):
    r, n = F.col("l_returnflag"), F.col("l_linenumber")
    p = t(s, sf, "lineitem").select("l_orderkey", n.alias("page_number"), F.when(r == "R", "scan_degraded").when(r == "A", "digital_clean").otherwise("mixed_content").alias("quality_class"), (r == "R").alias("ocr_required"), (F.col("l_linestatus") == "F").alias("suspicious_text_layer"))
    q = series.quality_summary(p, ["l_orderkey"])
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    counts = F.array_join(F.transform(F.map_entries("quality_class_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return q.select("l_orderkey", counts.alias("counts"), joined("ocr_required_pages").alias("ocr"), joined("suspicious_text_layer_pages").alias("suspicious"))


_BANDS = "b AS (SELECT user_id, row_number() OVER w AS i, CAST(value AS DOUBLE) AS off, CASE WHEN event_id % 3 = 0 THEN 60 ELSE 20 END AS high, lead(CAST(value AS DOUBLE)) OVER w AS after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"


@query("clean_bands", f"""WITH RECURSIVE {_BANDS}, r AS (SELECT user_id, i, off AS last, false AS gone FROM b WHERE i = 1
 UNION ALL SELECT b.user_id, b.i, CASE WHEN b.after IS NOT NULL AND high <= 40 AND abs(last - b.after) <= 10 AND abs(off - last) >= 30 AND abs(off - b.after) >= 30 THEN last ELSE off END, coalesce(b.after IS NOT NULL AND high <= 40 AND abs(last - b.after) <= 10 AND abs(off - last) >= 30 AND abs(off - b.after) >= 30, false) FROM r JOIN b ON b.user_id = r.user_id AND b.i = r.i + 1)
SELECT user_id, count(*) FILTER (NOT gone) AS bands, round(sum(CASE WHEN NOT gone THEN last END), 6) AS total FROM r GROUP BY 1""")
def _(s, sf):
    e = t(s, sf, "events").select("user_id", "event_id", F.col("value").cast("double").alias("off"), F.when(F.col("event_id") % 3 == 0, 60).otherwise(20).alias("high"))
    # Bands follow one another; only their heights matter.
    rows = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "off", "high"))).alias("b"))
    made = F.transform("b", lambda x: F.struct(F.lit(0).alias("top"), x["high"].alias("bottom"), x["off"].alias("off")))
    c = rows.withColumn("m", made).select("user_id", series.without_outlier_bands(F.col("m")).alias("c"))
    return c.select("user_id", F.size("c").cast("bigint").alias("bands"), F.round(F.aggregate("c", F.lit(0.0), lambda a, x: a + x["off"]), 6).alias("total"))


@query("tracked_marks", """WITH RECURSIVE c AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, CAST(value AS DOUBLE) AS a, CAST(value / 2 AS DOUBLE) AS b FROM events),
r AS (SELECT user_id, i, a AS last, a AS got FROM c WHERE i = 1
 UNION ALL SELECT c.user_id, c.i, CASE WHEN least(abs(a - last), abs(b - last)) <= 15 THEN CASE WHEN abs(a - last) <= abs(b - last) THEN a ELSE b END ELSE last END, CASE WHEN least(abs(a - last), abs(b - last)) <= 15 THEN CASE WHEN abs(a - last) <= abs(b - last) THEN a ELSE b END END FROM r JOIN c ON c.user_id = r.user_id AND c.i = r.i + 1)
SELECT user_id, count(got) AS n, round(sum(got), 6) AS total FROM r GROUP BY 1""")
def _(s, sf):
    e = t(s, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.col("value").cast("double").alias("v")))).alias("e"))
    p = e.select("user_id", series.tracked(F.transform("e", lambda x: F.array(x["v"], x["v"] / 2)), 15.0).alias("p"))
    got = F.filter("p", lambda x: x.isNotNull())
    return p.select("user_id", F.size(got).cast("bigint").alias("n"), F.round(F.aggregate(got, F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("segment_bands", """WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS y, CASE WHEN event_id % 5 <> 0 THEN CAST(value / 10 AS DOUBLE) END AS v, count(*) OVER (PARTITION BY user_id) AS n FROM events),
r AS (SELECT user_id, CAST(-1 AS BIGINT) AS y, CAST(0 AS BIGINT) AS start, CAST([] AS DOUBLE[]) AS held, any_value(n) AS n, CAST(NULL AS BIGINT) AS top, CAST(NULL AS BIGINT) AS bottom, CAST(NULL AS DOUBLE) AS off FROM e GROUP BY user_id
 UNION ALL SELECT user_id, y, CASE WHEN v IS NULL OR (len(held) > 0 AND NOT jump) THEN start ELSE y END, CASE WHEN v IS NULL THEN held WHEN jump THEN [v] ELSE list_append(held, v) END, n, CASE WHEN jump AND y - start >= 10 THEN start END, CASE WHEN jump AND y - start >= 10 THEN y END, CASE WHEN jump AND y - start >= 10 THEN list_median(held) END
 FROM (SELECT r.user_id, e.y, e.v, r.n, r.start, r.held, coalesce(e.v IS NOT NULL AND len(r.held) > 0 AND abs(e.v - list_median(r.held)) > 12, false) AS jump FROM r JOIN e ON e.user_id = r.user_id AND e.y = r.y + 1))
SELECT user_id, top, bottom, round(off, 6) AS off FROM r WHERE top IS NOT NULL UNION ALL SELECT user_id, start, n, round(list_median(held), 6) FROM r WHERE y = n - 1 AND len(held) > 0 AND n - start >= 10""")
def _(s, sf):
    w = W.partitionBy("user_id").orderBy("event_id")
    e = t(s, sf, "events").select("user_id", (F.row_number().over(w) - 1).alias("y"), F.when(F.col("event_id") % 5 != 0, (F.col("value") / 10).cast("double")).alias("v"))
    return series.bands(e, ["user_id"], "y", "v").select("user_id", "top", "bottom", F.round("off", 6).alias("off"))


# Sources and sinks -----------------------------------------------------------------------------


@query("locate_files", f"""WITH f AS (SELECT {_ID.format('o_orderkey')} || CASE WHEN o_custkey % 3 = 0 THEN '' ELSE '(' || (o_custkey % 3) || ')' END AS stem, '/in/' || o_custkey || '/' || o_orderkey AS path FROM orders WHERE o_custkey % 4 <> 1),
i AS (SELECT DISTINCT {_ID.format('l_orderkey')} AS case_id FROM lineitem)
SELECT case_id, coalesce((SELECT min(path) FROM f WHERE stem = case_id), (SELECT min(path) FROM f WHERE starts_with(stem, case_id))) AS path FROM i""")
def _(s, sf):
    c = F.col("o_custkey")
    files = t(s, sf, "orders").where("o_custkey % 4 <> 1").select(F.concat(_case("o_orderkey"), F.when(c % 3 == 0, "").otherwise(F.concat(F.lit("("), (c % 3).cast("string"), F.lit(")")))).alias("stem"), F.concat(F.lit("/in/"), c.cast("string"), F.lit("/"), F.col("o_orderkey").cast("string")).alias("path"))
    return readers.located(t(s, sf, "lineitem").select(_case("l_orderkey").alias("case_id")).distinct(), files)


@query("sorted_json", "SELECT CAST(to_json(struct_pack(a := n_regionkey, b := CASE WHEN n_nationkey % 2 = 0 THEN n_name END, c := n_nationkey)) AS VARCHAR) AS value FROM nation")
def _(s, sf):
    return writers.sorted_json(t(s, sf, "nation").select(F.col("n_nationkey").alias("c"), F.col("n_regionkey").alias("a"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("b")))


# Text and scores -------------------------------------------------------------------------------


@query("strip_accents", "SELECT c_custkey, strip_accents(translate(n_name, 'AEIOUN', 'ÁÊÌÖǗÑ') || ' é' || c_custkey) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(s, sf):
    rows = t(s, sf, "customer").join(F.broadcast(t(s, sf, "nation").select("n_nationkey", F.translate("n_name", "AEIOUN", "ÁÊÌÖǗÑ").alias("n"))), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", similarity.without_accents(F.concat("n", F.lit(" é"), F.col("c_custkey").cast("string"))).alias("v"))


@query("meaningful_share", r"WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda x: x <> '') AS w FROM documents) SELECT doc_id, coalesce(len(list_filter(w, lambda x: regexp_full_match(x, '[A-Za-z]{3,}')))::DOUBLE / nullif(len(w), 0), 0.0) AS share FROM w")
def _(s, sf):
    return t(s, sf, "documents").select("doc_id", series.meaningful_share(F.coalesce("text", F.lit(""))).alias("share"))


@query("combined_score", "SELECT l_orderkey, l_linenumber, round(0.55 * l_tax * 10 + 0.20 * l_discount * 10 + 0.15 * (l_quantity / 50) + 0.10 * least(greatest((l_quantity * 3 - 20) / 100.0, 0.0), 1.0) - 0.05 * least(l_linenumber / 3.0::DOUBLE, 1.0), 9) AS score, count(*) AS n FROM lineitem GROUP BY ALL")
def _(s, sf):
    score = series.combined_score(F.col("l_discount") * 10, F.col("l_tax") * 10, F.col("l_quantity") * 3 - 20, F.col("l_quantity") / 50, F.col("l_linenumber"))
    return t(s, sf, "lineitem").groupBy("l_orderkey", "l_linenumber", F.round(score.cast("double"), 9).alias("score")).agg(F.count(F.lit(1)).alias("n"))


@query("candidate_score", "SELECT doc_id, round(25.0 * (doc_id % 2 = 0)::INT + doc_id % 20 + 10.0 * (doc_id % 10 / 10.0::DOUBLE) + 6.0 * (doc_id % 7) + 0.02 * CASE WHEN doc_id % 3 = 0 THEN 0.0 ELSE doc_id % 100 END + 0.005 * least(length(regexp_replace(text, '^ +| +$', '', 'g')), 500), 9) AS score FROM documents WHERE text IS NOT NULL")
def _(s, sf):
    k = F.col("doc_id")
    score = pages.candidate_score(F.col("text"), F.when(k % 3 != 0, k % 100), k % 2 == 0, k % 20, k % 10 / 10.0, k % 7)
    return t(s, sf, "documents").where("text IS NOT NULL").select("doc_id", F.round(score.cast("double"), 9).alias("score"))


@query("classification_confidence", """WITH c AS (SELECT p_partkey, (p_partkey % 2) * 8 + (p_partkey // 2 % 2) * 4 + (p_partkey // 4 % 2) * 2 + (p_partkey // 8 % 2) * 3 + (p_partkey // 16 % 2) * 3 AS score, p_partkey % 2 = 1 AS headed FROM part)
SELECT p_partkey, CASE WHEN score >= 5 THEN 'fee_receipt' ELSE 'unknown' END AS document_type, score, CASE WHEN score >= 5 THEN round(least(CASE WHEN headed THEN 9.0 ELSE 0.9 END, 1.0, 0.35::DOUBLE + 0.035 * score + 0.04 * score), 3) ELSE 0.0 END AS confidence FROM c""")
def _(s, sf):
    k = F.col("p_partkey")
    bit = lambda n, text: F.when(F.floor(k / n) % 2 == 1, text)
    text = F.concat_ws(" ~ ", bit(1, "Fee-Receipt"), bit(2, "FEE STATUS: x"), bit(4, "amount 7"), bit(8, "Waiver|Code"), bit(16, "payment / reference"), F.lit("nothing else"))
    return t(s, sf, "part").select("p_partkey", pages.classified(text).alias("c")).select("p_partkey", "c.document_type", "c.score", "c.confidence")


@query("registry_fields", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Zed Quill ' || chr(CAST(65 + o_custkey % 26 AS INT)) END AS applicant, 'World ' || o_custkey AS home_world, CASE WHEN o_orderkey % 3 <> 0 THEN 'ORION_GRAYS' END AS species_code, CASE WHEN o_orderkey % 5 = 0 THEN 'Under embargo' ELSE 'Clear' END AS registry_status, '2026/' || (o_custkey % 9 + 1) || '/07' AS arrival_date FROM orders")
def _(s, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.concat_ws(" ", F.lit("PLANETARY REGISTRY EXTRACT"), F.when(k % 2 == 0, F.concat(F.lit("Registry Name: Zed Quill "), F.char(65 + c % 26))), F.lit("Home World - World"), c.cast("string"), F.when(k % 3 != 0, "Species Code; ORION_GRAYS"), F.when(k % 5 == 0, "Registry Status: Under embargo").otherwise("Registry Status. Clear"), F.concat(F.lit("Antval Date: 2026/"), (c % 9 + 1).cast("string"), F.lit("/07")), F.lit("Packet MIB-000001 / page 2"))
    m = t(s, sf, "orders").select("o_orderkey", pages.extracted(F.lit("registry_extract"), text).alias("f"))
    return m.select("o_orderkey", *[m.f[x].alias(x) for x in ("applicant", "home_world", "species_code", "registry_status", "arrival_date")])


@query("note_fields", "SELECT o_orderkey, 'MIB-' || o_custkey AS case_id, CASE o_orderkey % 3 WHEN 0 THEN 'DENIED' WHEN 1 THEN 'REVIEW' END AS decision, CASE WHEN o_orderkey % 2 = 0 THEN 'flag ' || o_orderkey || ' on file' END AS reason FROM orders")
def _(s, sf):
    k = F.col("o_orderkey")
    text = F.concat(F.lit("Adjudicator note on mib-0 and MIB-"), F.col("o_custkey").cast("string"), F.lit("\n"), F.when(k % 3 == 0, "Finding: DENIED").when(k % 3 == 1, " REVIEW ").otherwise("Finding: open"), F.lit("\n"), F.when(k % 2 == 0, F.concat(F.lit("Reason:  flag "), k.cast("string"), F.lit(" on file"))).otherwise("no reason"), F.lit(" Packet MIB-000001 / page 3"))
    text = F.replace(text, F.lit("mib-0 and "), F.lit(""))
    m = t(s, sf, "orders").select("o_orderkey", pages.extracted(F.lit("adjudicator_note"), text).alias("f"))
    return m.select("o_orderkey", *[m.f[x].alias(x) for x in ("case_id", "decision", "reason")])


@query("extraction_score", "SELECT CAST(sum(CASE WHEN c_custkey % 3 <> 0 THEN 5 ELSE 0 END + CASE WHEN c_custkey % 5 <> 0 THEN 4 ELSE 0 END) AS BIGINT) AS raw, CAST(count(*) * 9 AS BIGINT) AS most, 50 * (sum(CASE WHEN c_custkey % 3 <> 0 THEN 5 ELSE 0 END + CASE WHEN c_custkey % 5 <> 0 THEN 4 ELSE 0 END)::DOUBLE / (count(*) * 9)) AS score FROM customer")
def _(s, sf):
    k = F.col("c_custkey")
    pairs = t(s, sf, "customer").select(k.alias("case_id"), F.lit("XW-1").alias("truth_visa_class"), F.when(k % 3 != 0, "xw-1").alias("pred_visa_class"), F.lit("paid").alias("truth_fee_status"), F.when(k % 5 != 0, "paid").otherwise("waived").alias("pred_fee_status"), F.lit(True).alias("present"), F.lit(None).cast("array<string>").alias("unrecoverable"))
    e = evaluate.extraction_score(evaluate.field_scores(pairs, {"visa_class": 5, "fee_status": 4}))
    return e.select(F.col("raw").cast("bigint").alias("raw"), F.col("most").cast("bigint").alias("most"), "score")


@query("first_arrivals", "SELECT DISTINCT user_id FROM events")
def _(s, sf):
    return arrivals.first_arrivals(t(s, sf, "events"), "user_id", "ts").select("user_id")


@query("index_counts", "WITH c AS (SELECT CASE WHEN event_id % 11 = 0 THEN ' ' ELSE 'u' || user_id END AS k FROM events), g AS (SELECT trim(k) AS k, count(*) AS n FROM c GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (k = ''), 0) AS BIGINT) AS blank, CAST(sum(n - 1) FILTER (k <> '') AS BIGINT) AS repeated, count(*) FILTER (k <> '') AS kept FROM g")
def _(s, sf):
    e = t(s, sf, "events").select(F.when(F.col("event_id") % 11 == 0, " ").otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("k"))
    return evaluate.index_counts(e, "k")


@query("value_sets", "SELECT l_orderkey, l_returnflag AS field, array_to_string(list_sort(list_distinct(list(CASE WHEN l_linenumber <> 2 THEN CAST(l_suppkey AS VARCHAR) END))), ',') AS v FROM lineitem GROUP BY 1, 2 HAVING count(CASE WHEN l_linenumber <> 2 THEN 1 END) > 0")
def _(s, sf):
    rows = t(s, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("field"), F.when(F.col("l_linenumber") == 2, "  ").otherwise(F.concat(F.lit(" "), F.col("l_suppkey").cast("string"))).alias("value"))
    return identity.value_sets(rows, ["l_orderkey"]).select("l_orderkey", "field", F.array_join("values", ",").alias("v"))


def _read_badly(values: Column, k: Column) -> Column:
    """A value as written, in capitals with wide gaps, with accents, with a letter misread."""
    return F.when(k % 4 == 0, values).when(k % 4 == 1, F.replace(F.upper(values), F.lit(" "), F.lit("   "))).when(k % 4 == 2, F.translate(values, "aeo", "áëö")).otherwise(F.concat(F.substring(values, 1, 2), F.lit("q"), F.substr(values, F.lit(4))))


def _normal(s, sf, field: str, values: tuple[str, ...], key: str = "o_orderkey") -> DataFrame:
    k = F.col(key)
    raw = _read_badly(pick(F.floor(k / 4) % len(values), values), k)
    rows = t(s, sf, "orders").select(key, F.lit(field).alias("field"), raw.alias("raw_value"))
    return normalize.normalized(rows, out="v").select(key, "v")


@query("norm_home_world", f"SELECT o_orderkey, {list(vocab.HOME_WORLDS)}[o_orderkey // 4 % {len(vocab.HOME_WORLDS)} + 1] AS v FROM orders")
def _(s, sf):
    return _normal(s, sf, "home_world", vocab.HOME_WORLDS)


@query("norm_purpose", f"SELECT o_orderkey, {list(vocab.PURPOSES)}[o_orderkey // 4 % {len(vocab.PURPOSES)} + 1] AS v FROM orders WHERE o_orderkey % 4 <> 2")
def _(s, sf):
    return _normal(s, sf, "declared_purpose", vocab.PURPOSES).where("o_orderkey % 4 <> 2")


@query("norm_applicant", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN c_name ELSE c_name || ' x' END AS v FROM customer")
def _(s, sf):
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, pick(F.floor(k / 3) % 3, ("[NAME CUT OUT]", "(NAME CUT OLIT] Species", "name cut 0ut"))).when(k % 3 == 1, F.concat(F.lit("  "), "c_name")).otherwise(F.concat("c_name", F.lit(" x ")))
    rows = t(s, sf, "customer").select("c_custkey", F.lit("applicant_name").alias("field"), raw.alias("raw_value"))
    return normalize.normalized(rows, out="v").select("c_custkey", "v")
