"""Outcomes of resolution, decisions, normalizers and sources, derived by hand."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from caseloom.functions import normalize, similarity
from caseloom.operators import derive, identity, labelled, pages, predict, resolve
from caseloom.sources import readers, writers

SCHEMA = "case_id string, page_number int, seq long, document_type string, text_source string, field string, normalized_value string"


def outcome(spark, field, readings):
    rows = [("c", p, i, kind, source, field, value) for i, (p, kind, source, value) in enumerate(readings)]
    random.Random(3).shuffle(rows)
    r = resolve.resolved(spark.createDataFrame(rows, SCHEMA)).first()
    return r["resolved_value"], r["status"], r["resolution_method"]


@pytest.mark.parametrize(
    ("field", "readings", "expected"),
    [
        ("visa_class", [(1, "intake_form", "ocr", None)], (None, "missing", "no_usable_observation")),
        ("visa_class", [(1, "intake_form", "ocr", "XW-1")], ("XW-1", "single_source", "single_observation")),
        ("sponsor_id", [(1, "intake_form", "ocr", "SPN-6818"), (4, "sponsor_attestation", "ocr", "SPN-6818")], ("SPN-6818", "corroborated", "exact_match")),
        ("sponsor_id", [(1, "intake_form", "ocr", "SPN-3"), (2, "sponsor_attestation", "ocr", "SPN-3677")], ("SPN-3677", "single_source", "shape_valid_preferred_over_malformed")),
        ("applicant_name", [(1, "intake_form", "ocr", "Zed Q"), (2, "registry_extract", "native_text", "Ann Bell")], ("Ann Bell", "single_source", "native_preferred_over_ocr")),
        ("visa_class", [(1, "intake_form", "ocr", "XW-1"), (1, "fee_receipt", "ocr", "XW-2")], (None, "conflicting", "equal_priority_conflict")),
        ("visa_class", [(1, "registry_extract", "ocr", "XW-1"), (1, "fee_receipt", "ocr", "XW-2")], ("XW-2", "resolved_by_evidence_priority", "evidence_priority")),
        ("home_world", [(1, "intake_form", "native_text", "Titan Freeport"), (2, "intake_form", "ocr", "Titan Freeport a1b")], ("Titan Freeport", "single_source", "native_ocr_match")),
        ("home_world", [(1, "intake_form", "native_text", "Titan Freeport"), (2, "intake_form", "ocr", "Titan Freeport a1bc")], (None, "conflicting", "equal_priority_conflict")),
    ],
)
def test_resolution(spark, field, readings, expected):
    assert outcome(spark, field, readings) == expected


@pytest.mark.parametrize(
    ("visa", "arrival", "flag", "fee", "sponsor", "note", "conflict", "rule"),
    [
        ("XW-1", "2026-01-12", "none", "paid", "SPN-1111", None, False, "stale_application"),
        ("XW-1", "2026-01-13", "none", "paid", "SPN-1111", None, False, "clean_packet"),
        ("DIP-1", "2020-01-01", "none", "paid", "SPN-4040", None, False, "clean_packet"),
        (None, "2026-07-01", "none", "paid", "SPN-4040", None, False, "revoked_sponsor"),
        ("XW-1", "2026-07-01", "none", None, "SPN-1111", None, False, "unresolved_fee"),
        ("XW-1", "2026-07-01", "biohazard_red", "paid", None, "review", False, "adjudicator_note"),
        ("XW-1", "2026-07-01", "none", "paid", None, None, False, "missing_sponsor"),
        (None, "2026-07-01", "none", "paid", "SPN-1111", None, False, "insufficient_evidence"),
        ("XW-1", "2026-07-01", "none", "odd", "SPN-1111", None, False, "fallback"),
        ("XW-1", "2026-07-01", "identity_conflict", "paid", "SPN-1111", None, False, "review_risk_flag"),
    ],
)
def test_decision(spark, visa, arrival, flag, fee, sponsor, note, conflict, rule):
    one = spark.createDataFrame([(visa, arrival, flag, fee, sponsor, note, conflict)], "visa string, arrival string, flag string, fee string, sponsor string, note string, conflict boolean")
    c = {n: F.col(n) for n in one.columns}
    made = derive.adjudicated(c["note"], c["visa"], c["arrival"], F.array(c["flag"]), c["fee"], c["sponsor"], c["conflict"])
    assert one.select(made.alias("a")).first()["a"]["rule"] == rule


def test_normalizers_on_odd_values(spark):
    one = spark.createDataFrame([(None, "", "2026-1-5", "2026")], "a string, b string, c string, d string")
    r = one.select(normalize.date(F.col("a")), normalize.date(F.col("b")), normalize.date(F.col("c")), normalize.date(F.col("d")), normalize.amount(F.lit(",")), normalize.sponsor_id(F.lit("spn_68 i8")), normalize.risk_flags(F.col("a"))).first()
    assert list(r) == [None, None, "2026-01-05", "2026", None, "SPN-6818", None]


def test_similarity():
    assert similarity.ratio("tide", "diet") == 0.25 and similarity.ratio("diet", "tide") == 0.5
    assert similarity.best("xencbotany", ("xenobotany", "transit"), 0.72, 0.08) == "xenobotany"
    assert similarity.best("ab", ("ac", "ad"), 0.1, 0.08) is None


def test_extraction(spark):
    text = "MIB Intake Form Case ID: MIB-000123 Applicant: Zed Quill Species Code: ORION_GRAYS Home World: Titan Freeport Visa Class: XW-1 Sponsor ID: SPN-1234 Arrival Date: 2026-05-01 Declared Purpose: field repair Packet MIB-000123 / page 1"
    one = spark.createDataFrame([(text,)], "t string")
    f = one.select(pages.extracted(F.lit("intake_form"), F.col("t")).alias("f"), pages.classified(F.col("t")).alias("c")).first()
    assert f["f"] == {"case_id": "MIB-000123", "applicant": "Zed Quill", "species_code": "ORION_GRAYS", "home_world": "Titan Freeport", "visa_class": "XW-1", "sponsor_id": "SPN-1234", "arrival_date": "2026-05-01", "declared_purpose": "field repair"}
    assert f["c"]["document_type"] == "intake_form"


def test_sources_and_sinks(spark, tmp_path):
    rows = writers.baseline(spark.createDataFrame([("MIB-000002",), ("MIB-000001",)], "case_id string"))
    writers.write_jsonl(rows, f"{tmp_path}/out", single=True)
    back = readers.jsonl_rows(spark, f"{tmp_path}/out")
    assert [r["case_id"] for r in back.collect()] == ["MIB-000001", "MIB-000002"]
    (tmp_path / "pretty.json").write_text('{\n  "results": [\n    {"case_id": "a"}\n  ]\n}')
    assert [r["case_id"] for r in readers.submission(spark, f"{tmp_path}/pretty.json").collect()] == ["a"]
    for name, body in {"list": '[{"case_id": "a"}]', "named": '{"predictions": [{"case_id": "a"}]}', "single": '{"case_id": "a"}', "keyed": '{"a": {"confidence": 0.5}}'}.items():
        (tmp_path / f"{name}.json").write_text(body)
        assert [r["case_id"] for r in readers.submission(spark, f"{tmp_path}/{name}.json").collect()] == ["a"], name
    (tmp_path / "x.csv").write_text("﻿case_id,b\n1,2\n", encoding="utf-8")
    assert readers.csv_rows(spark, f"{tmp_path}/x.csv").columns == ["case_id", "b"]
    with pytest.raises(ValueError):
        readers.csv_rows(spark, f"{tmp_path}/x.csv", ["case_id"])
    (tmp_path / "pdfs").mkdir()
    for n in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / "pdfs" / n).write_bytes(b"x")
    assert sorted(r["case_id"] for r in readers.packets(spark, f"{tmp_path}/pdfs").collect()) == ["a", "b"]


@pytest.mark.parametrize(
    ("field", "raw", "expected"),
    [
        ("visa_class", "XWV-1", "XW-1"), ("visa_class", "XW-", None), ("visa_class", "zzz", None), ("species_code", "ORI0N GRAY5", "ORION_GRAYS"), ("species_code", "garbage", None),
        ("home_world", "GiieSé-581g)", "Gliese-581g"), ("home_world", "titan  FREEPORT", "Titan Freeport"), ("declared_purpose", "Xencbotany", "xenobotany"), ("declared_purpose", "Field  Repair", "field repair"),
        ("risk_flags", "biohazard_rcd", "biohazard_red"), ("risk_flags", "none;act1ve warrant|biohazard_rcd", "active_warrant|biohazard_red"), ("risk_flags", "zz", None), ("risk_flags", "zz,none", "none"),
        ("applicant_name", "(NAME CUT OLIT] Specees", None), ("applicant_name", " Zed Quill ", "Zed Quill"), ("waiver", " x ", "x"),
    ],
)
def test_best_matches(spark, field, raw, expected):
    rows = spark.createDataFrame([(1, field, raw), (2, field, None)], "n int, field string, raw_value string")
    assert [r["normalized_value"] for r in normalize.normalized(rows).orderBy("n").collect()] == [expected, None]


@pytest.mark.parametrize(
    ("kind", "text", "strict", "expected"),
    [
        ("fee_receipt", "MIB Fee Receipt Foe Status: unpaid Amount: $120.00", {"amount": "120.00"}, {"amount": "120.00", "fee_status": "unpaid"}),
        ("intake_form", "Home Workt: Proxima-b Visa Class: XW-1", {"visa_class": "XW"}, {"home_world": "Proxima-b", "visa_class": "XW-1"}),
        ("intake_form", "Declared Purpose: xencbotany | --| vat PO", {"declared_purpose": "xencbotany | --| vat PO"}, {"declared_purpose": "xenobotany"}),
        ("fee_receipt", "Home Workt: Proxima-b", {}, {}),
        ("biometric_slip", "Observed flags: active_warrant|biohazard_red", {"observed_flags": "active_warrant|biohazard_red"}, {"observed_flags": "active_warrant|biohazard_red"}),
        ("unknown", "Foe Status: unpaid", {}, {"fee_status": "unpaid"}),
    ],
)
def test_damaged_labels(spark, kind, text, strict, expected):
    one = spark.createDataFrame([(kind, text, strict), (kind, None, strict)], "document_type string, text string, found map<string,string>")
    got = labelled.completed(one).collect()
    assert [r.found for r in got if r.text is not None] == [expected] and [r.found for r in got if r.text is None] == [strict]


def test_damaged_pages_reach_the_decision(spark):
    rows = [
        ("MIB-000001", 1, "MIB Intake Form Case ID: MIB-000001 Applicant: Zed Quill Species Code: ORION_GRAYS Home Workt: Titan Freeport Visa Class: XW-1 Sponsor ID: SPN-1234 Arrival Date: 2026-05-01 Declared Purpose: field repair Packet MIB-000001 / page 1", "native_text"),
        ("MIB-000001", 2, "MIB Fee Receipt Case ID: MIB-000001 Foe Status: unpaid Waiver Code: N/A", "native_text"),
        ("MIB-000002", 1, None, "none"),
    ]
    got = predict.predicted(spark.createDataFrame(rows, "case_id string, page_number int, text string, text_source string")).collect()
    assert [(r.case_id, r.home_world, r.fee_status, r.adjudication) for r in got] == [("MIB-000001", "Titan Freeport", "unpaid", "DENIED")]


@pytest.mark.parametrize(
    ("written", "read", "expected"),
    [("Oririx Orivoss", "Orirx Orivoss Spr~- \"te. URION_GRAYS", True), ("Zed Quill", "Zed Quil", True), ("Zed Quill", "ZED QUILL", True), ("Zed Quill", "Mo Brask", False), ("Zed Quill", "  ", False)],
)
def test_links_by_noisy_names(spark, written, read, expected):
    page = [("p", "9", "applicant_name", read), ("p", "9", "species_code", "ARCTURIAN")]
    case = [("p", "c", "applicant_name", "Someone Else"), ("p", "c", "applicant_name", written), ("p", "c", "species_code", "ARCTURIAN")]
    r = identity.link_scores(spark.createDataFrame(page, "packet string, page_number string, field string, value string"), spark.createDataFrame(case, "packet string, case_id string, field string, value string")).first()
    assert (r.score, r.matched, r.conflicts, r.safe) == ((8, 2, "", True) if expected else (-2, 1, "applicant_name", False))


def test_near_ids_of_unlike_length(spark):
    rows = [("p", "MIB-000557")] * 2 + [("p", "MIB-000557123"), ("p", "MIB-0005571234")]
    got = identity.near_established(spark.createDataFrame(rows, "packet string, case_id string")).collect()
    assert [tuple(r) for r in got] == [("p", "MIB-000557123", "MIB-000557")]


def test_near_ids_by_all_pairs(spark):
    """Damaged ids of several lengths against all pairs; with few characters to leave out, and with none."""
    r = random.Random(5)
    rows = []
    for packet in "pq":
        known = [f"MIB-{r.randrange(10**6):06d}" for _ in range(25)] + ["X" * 30 + f"{r.randrange(100):02d}", "a", ""]
        rows += [(packet, k) for k in known] * 2
        for k in known:
            for _ in range(3):
                v = list(k)
                for _ in range(r.choice([1, 1, 2])):
                    at = r.randrange(len(v) + 1)
                    v[at : at + r.choice([0, 1])] = r.choice([[], ["0"], ["1"], list("B")])
                rows.append((packet, "".join(v)))
        r.shuffle(rows)
    seen = collections.Counter(rows)
    expected = set()
    for (packet, one), n in seen.items():
        scores = sorted((-similarity.ratio(one, k), k) for (p, k), m in seen.items() if p == packet and m > 1)
        if n == 1 and -scores[0][0] >= 0.85:
            expected.add((packet, one, scores[0][1]))
    df = spark.createDataFrame(rows, "packet string, case_id string")
    assert {tuple(x) for x in identity.near_established(df).collect()} == expected and len(expected) > 40


def test_links_against_brute_force_without_written_pairs(spark, monkeypatch):
    import random

    from caseloom.functions import vocab
    from caseloom.functions.similarity import alike

    rng = random.Random(7)
    fields = {"applicant_name": ["Zed Quill", "Zcd Quill", "Orikesh Antari", ""], "sponsor_id": ["a", "b", "c"], "visa_class": ["x", "y", None], "fee_status": ["paid", "waived"], "other": ["1", "2"]}
    made = lambda owners: [(p, o, f, rng.choice(v)) for p in ("p", "q", "r") for o in owners for f, v in fields.items() for _ in range(rng.randint(0, 2))]
    page, case = made([str(i) for i in range(9)]), [x for x in made([f"c{i}" for i in range(7)]) if x[0] != "r"] + [("s", "c0", "visa_class", "x")]
    expected = {}
    for p, o in sorted({(x[0], x[1]) for x in page}):
        ranked = []
        for c in sorted({x[1] for x in case if x[0] == p}):
            here = {f: ([x[3] for x in page if x[:3] == (p, o, f)], [x[3] for x in case if x[:3] == (p, c, f)]) for f in fields}
            same = {f: any(x is not None and (x == y or f == "applicant_name" and alike(y, x)) for x in a for y in b if y is not None) for f, (a, b) in here.items() if a and b}
            if same:
                score = sum(vocab.LINK_WEIGHTS.get(f, 0) if s else -vocab.LINK_PENALTIES.get(f, 0) for f, s in same.items())
                ranked.append((-score, c, sum(same.values()), ",".join(sorted(f for f, s in same.items() if not s))))
        ranked.sort()
        if ranked:
            score, c, matched, conflicts = ranked[0]
            expected[p, o] = (c, -score, matched, conflicts, -ranked[1][0] if len(ranked) > 1 else 0)
    schema = "packet string, {} string, field string, value string"
    got = identity.link_scores(spark.createDataFrame(page, schema.format("page_number")), spark.createDataFrame(case, schema.format("case_id")))
    assert {(r.packet, r.page_number): (r.case_id, r.score, r.matched, r.conflicts, r.second) for r in got.collect()} == expected
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()  # pairs of pages and cases are no rows
