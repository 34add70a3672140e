"""Rules of observation, checks, errors, trials, series, sources, on odd values."""

import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from caseloom.functions import similarity, vocab
from caseloom.operators import check, evaluate, labelled, observe, pages, predict, resolve, series, trials, triage
from caseloom.sources import readers, writers


def one(spark, **values):
    return spark.createDataFrame([tuple(values.values())], list(values))


@pytest.mark.parametrize(
    ("name", "plausible"),
    [("Zed Quillon", True), ("  Zed Quillon ", True), ("Mo Brask", False), ("Zed  Quillon", False), ("Jean-Luc Picard", True), ("Zed Quillon III", False), ("Zed Qu1llon", False), ("Talvennarix Parquestion", False), ("", False), (None, False)],
)
def test_names(spark, name, plausible):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(observe.plausible_name(F.col("n")).alias("p")).first().p is plausible


def test_missing_and_filled(spark):
    df = spark.createDataFrame([("fee_status", None), ("fee_status", ""), ("fee_status", "x"), ("applicant", "Orin"), ("applicant", "Orinax Miravara")], "f string, v string")
    assert [r.m for r in df.select(observe.missing(F.col("f"), F.col("v")).alias("m")).collect()] == [True, True, False, True, False]
    maps = spark.createDataFrame([({"a": "1", "b": None}, {"a": "2", "b": "3", "c": "4"}), ({}, {"a": ""})], "f map<string,string>, r map<string,string>")
    assert [r.m for r in maps.select(observe.filled(F.col("f"), F.col("r"), ["a", "b"]).alias("m")).collect()] == [{"a": "1", "b": "3"}, {}]
    assert [r.n for r in maps.select(observe.field_count(F.col("f")).alias("n")).collect()] == [1, 0]


def test_orphans(spark):
    lines = ["Fee: PAID", "Packet MIB-1 / page 2", "ab", "form b-13", "an odd line", "page x"]
    r = one(spark, lines=lines).select(observe.orphans(F.col("lines"), F.array(F.lit("paid"), F.lit(""), F.lit(None))).alias("o")).first()
    assert r.o == ["an odd line", "page x"]


def test_expected_case(spark):
    p = spark.createDataFrame([("p", 1, None, "none"), ("p", 2, None, "none"), ("q", 1, None, "none"), ("q", 2, "MIB-000001", "footer"), ("r", 1, None, "none")], "packet string, page_number int, case_id string, method string")
    e = spark.createDataFrame([("p", "MIB-000009"), ("q", "MIB-000008"), ("r", None)], "packet string, expected_case_id string")
    got = sorted(map(str, map(tuple, observe.assigned_or_expected(p, e).collect())))
    assert got == sorted(map(str, [("p", 1, "MIB-000009", "expected_case_fallback"), ("p", 2, "MIB-000009", "expected_case_fallback"), ("q", 1, None, "none"), ("q", 2, "MIB-000001", "footer"), ("r", 1, None, "none")]))
    assert observe.assigned_or_expected(p.limit(0), e).count() == 0


def test_id_candidates(spark):
    text = "x MIB-O0C1L2 | mib eyes only  Case 10: MIB-12345  Packet MIB-00000X / page 3 Cave ID MIB-000007"
    assert tuple(one(spark, t=text).select(observe.id_candidates(F.col("t")).alias("c")).first().c) == (None, "MIB-000112", "MIB-000007")
    assert tuple(spark.createDataFrame([(None,)], "t string").select(observe.id_candidates(F.col("t")).alias("c")).first().c) == (None, None, None)


def test_untrusted_readings_and_unknown_cases(spark):
    rows = [("c", 1, 1, "intake_form", "ocr", "visa_class", "XW-1", True), ("c", 1, 2, "fee_receipt", "ocr", "visa_class", "XW-2", False), (None, 1, 3, "fee_receipt", "ocr", "visa_class", "XW-2", True), ("c", 1, 4, "intake_form", "ocr", "fee_status", "paid", None)]
    df = spark.createDataFrame(rows, "case_id string, page_number int, seq long, document_type string, text_source string, field string, normalized_value string, trusted boolean")
    assert sorted(map(tuple, resolve.resolved(df).select("case_id", "field", "resolved_value", "status").collect()), key=str) == sorted([("c", "visa_class", "XW-1", "single_source"), ("c", "fee_status", None, "missing")], key=str)
    assert [r.normalized_value for r in observe.usable(df).collect()] == ["XW-1"]


ROW = {f: "" for f in check.FIELDS} | {"case_id": " MIB-000001 ", "sponsor_id": "SPN-0001", "arrival_date": "2026-02-28", "fee_status": "paid", "adjudication": "DENIED", "confidence": "0.5"}


@pytest.mark.parametrize(
    ("change", "messages"),
    [
        ({}, []), ({"arrival_date": "2026-02-30"}, ["invalid arrival_date: 2026-02-30"]), ({"arrival_date": "20260228"}, ["invalid arrival_date: 20260228"]), ({"confidence": "NaN"}, ["confidence out of range"]), ({"confidence": "inf"}, ["confidence out of range"]),
        ({"confidence": "x"}, ["confidence is not numeric"]), ({"case_id": "MIB-0000010", "sponsor_id": "spn-0001"}, ["invalid case_id: MIB-0000010", "invalid sponsor_id: spn-0001"]), ({"home_world": None, "z": "1"}, ["missing: home_world", "unexpected: z"]), ({"fee_status": "PAID", "adjudication": "approved"}, ["invalid fee_status: PAID", "invalid adjudication: approved"]),
    ],
)
def test_row_messages(spark, change, messages):
    row = {k: v for k, v in (ROW | change).items() if v is not None}
    df = spark.createDataFrame([(row,)], "r map<string,string>")
    assert df.select(check.row_messages(F.col("r"), None, "csv").alias("m")).first().m == messages


def test_row_types(spark):
    kinds = {f: "string" for f in check.FIELDS} | {"confidence": "boolean", "applicant_name": "number", "fee_status": "null"}
    df = spark.createDataFrame([(ROW, kinds)], "r map<string,string>, k map<string,string>")
    assert df.select(check.row_messages(F.col("r"), F.col("k")).alias("m")).first().m == ["applicant_name is no string", "fee_status is no string", "confidence is no number"]


def test_labels_are_checked(spark):
    rows = spark.createDataFrame([("a", "f", " regex ", "yes", None), ("b", "f", "bad", "", "now")], "case_id string, field string, root_cause string, recoverable string, fix_priority string")
    assert [tuple(r) for r in check.unknown_labels(rows).collect()] == [("b", "f", "root_cause", "bad")]
    assert check.with_known_labels(rows.where("case_id = 'a'")).count() == 1
    with pytest.raises(Exception, match="not on its list: b f"):
        check.with_known_labels(rows).collect()
    assert check.selected(rows.withColumn("path", F.col("case_id")), case_id="a").count() == 1


def test_written_values(spark):
    df = spark.createDataFrame([(" Yes", "3.9"), ("0", "-2.9"), (None, "x"), ("true", None), ("1", "NaN"), ("2", "inf")], "a string, b string")
    got = df.select(check.flag(F.col("a")).alias("f"), check.whole(F.col("b"), 5).alias("w")).collect()
    assert [(r.f, r.w) for r in got] == [(True, 3), (False, -2), (False, 5), (True, 5), (True, 5), (False, 5)]


def test_derivations_can_be_added(spark):
    w = {f"{c}_value": None for c in predict.FIELDS} | {f"{c}_status": None for c in predict.FIELDS}
    w |= {"case_id": "c", "registry_status_value": "under Embargo", "visa_class_value": "XW-1", "fee_status_value": "paid", "sponsor_id_value": "SPN-1111", "arrival_date_value": "2026-07-01"}
    df = spark.createDataFrame([tuple(w.values())], ", ".join(f"{k} string" for k in w))
    more = predict.DERIVATIONS | {"mine": lambda: F.when(F.col("visa_class_value") == "XW-1", "identity_conflict")}
    assert predict.decided(df).first().flags == "planetary_embargo"
    assert predict.decided(df, None, more).first().flags == "identity_conflict|planetary_embargo"


def plain_window(expected, text):
    wanted, words, top = expected.split(), text.split(), (0.0, "")
    for n in range(max(1, len(wanted) - 1), len(wanted) + 3):
        for i in range(len(words) - n + 1):
            piece = " ".join(words[i : i + n])
            score = SequenceMatcher(None, expected, piece).ratio()
            top = (score, piece) if score > top[0] else top
    return top if wanted else (0.0, "")


def test_values_found(spark):
    rows = [(1, "Sponsor: SPN 6799, due 2026-03-15", "sponsor", "SPN-6799"), (1, "Sponsor: SPN 6799, due 2026-03-15", "purpose", "field repair"), (2, "declared pvrpose fie1d repair soon", "purpose", "Field Repair"), (3, "", "purpose", "x"), (4, "some words", "purpose", "")]
    got = {(r.text_id, r.field): r for r in trials.values_found(spark.createDataFrame(rows, "text_id int, text string, field string, value string")).collect()}
    assert got[1, "sponsor"].outcome == "exact" and got[2, "purpose"].outcome == "fuzzy" and got[3, "purpose"].outcome == "miss" and got[4, "purpose"].outcome == "exact"
    for text, value in (("declared pvrpose fie1d repair soon", "field repair"), ("sponsor spn 6799 due 2026 03 15", "field repair"), ("a", "b c d"), ("", "x")):
        assert trials.best_window(value, text) == plain_window(value, text)
    assert got[2, "purpose"].credit == plain_window("field repair", "declared pvrpose fie1d repair soon")[0] and got[1, "purpose"].credit == 0
    sums = {r.text_id: r for r in trials.recovery(trials.values_found(spark.createDataFrame(rows, "text_id int, text string, field string, value string"))).collect()}
    assert (sums[1].value_score, sums[1].exact, sums[1].fuzzy) == (0.5, 1, 0)


def test_pruned_best_match_is_exact():
    terms = (*vocab.HOME_WORLDS, *vocab.PURPOSES)
    for value in ("Titan Freeprt", "research", "arch", "Proxima b", "zz", "Luyten", "field repai", "transit translation"):
        for least, margin in ((0.72, 0.08), (0.3, 0.01), (0.5, 0.2)):
            scores = sorted(((similarity.ratio(value, c), c) for c in terms), reverse=True)
            want = scores[0][1] if scores[0][0] >= least and scores[0][0] - scores[1][0] >= margin else None
            assert similarity.best(value, terms, least, margin) == want


def test_many_matches_are_single_matches():
    terms = tuple(labelled.ANY_LABELS)
    values = ["Hcme World", "Foe Status", "zz", None, "", "MIB-000123 Applicant", "Foe Status", "éé World", "Case 1D", "Declared Purpcse: x", "𝔸mount"]
    assert similarity.best_many(values, terms, 0.78, 0.10, similarity.compare_text) == [similarity.best(v, terms, 0.78, 0.10, similarity.compare_text) for v in values]
    assert similarity.best_many([], terms, 0.78, 0.10) == [] and similarity.best_many(["a"], (), 0.78, 0.10) == [None]
    words = ["".join(w) for w in __import__("itertools").product("abc", repeat=4)]
    assert similarity.best_many(words, ("abca", "cabb", "aaaa", "bcbc"), 0.5, 0.05) == [similarity.best(w, ("abca", "cabb", "aaaa", "bcbc"), 0.5, 0.05) for w in words]


def test_regions(spark):
    region = "region struct<x1:double,y1:double,x2:double,y2:double>"
    df = spark.createDataFrame([((0.0, 0.1, 0.5, 1.0),)], region)
    assert tuple(df.select(trials.pixels(F.col("region"), F.lit(100), F.lit(200), 10).alias("b")).first().b) == (0, 10, 60, 200)
    bad = spark.createDataFrame([((0.5, 0.1, 0.5, 1.0),), ((0.0, 0.1, 0.5, 1.5),), ((None, 0.1, 0.5, 1.0),)], region)
    assert [r.v for r in bad.select(F.coalesce(trials.valid_region(F.col("region")), F.lit(False)).alias("v")).collect()] == [False] * 3
    with pytest.raises(Exception, match="no region"):
        bad.select(trials.pixels(F.col("region"), F.lit(100), F.lit(200)).alias("b")).collect()


def test_labels_one_by_one(spark):
    text = "Case ID: MIB-O00123 Home  World - Proxima-b Amount 1,200.50 Sponser ID spn 1214 Applicant; Zedekiah Quill | x"
    p = spark.createDataFrame([(1, text, "unknown", []), (2, text, "fee_receipt", ["amount"]), (3, "", "unknown", []), (4, "no labels here", "unknown", []), (5, "12Case ID3 MIB-000001", "unknown", [])], "_page long, text string, kind string, wanted array<string>")
    got = {r._page: r.loose for r in labelled.fields_by_labels(p).collect()}
    assert got[1] == {"case_id": "MIB-O00123", "home_world": "Proxima-b", "amount": "1,200.50", "sponsor_id": "spn 1214", "applicant": "Zedekiah Quill"} and got[2] == {"amount": "1,200.50"} and set(got) <= {1, 2, 5}


def test_robust_fit_and_median(spark):
    rows = [("g", float(x), 2.0 * x + 1 + (500 if x == 7 else 0) + (0.01 if x % 2 else -0.01)) for x in range(40)] + [("h", 1.0, 2.0), ("h", 2.0, 4.0)]
    f = {r.g: r for r in series.trimmed_fit(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y").collect()}
    assert abs(f["g"].slope - 2) < 0.01 and f["g"].n < 40 and f["h"].n == 2
    m = {r.g: r.median for r in series.robust_median(spark.createDataFrame([("a", v) for v in (1.0, 2.0, 2.0, 3.0, 99.0)] + [("b", 5.0)], "g string, v double"), ["g"], "v").collect()}
    assert m == {"a": 2.0, "b": 5.0}


def test_tracks(spark):
    df = spark.createDataFrame([([[1.0, 9.0], [], [2.0, 8.0], [30.0], [3.0]],), ([],)], "v array<array<double>>")
    assert [r.p for r in df.select(series.tracked(F.col("v"), 5.0).alias("p")).collect()] == [[1.0, None, 2.0, None, 3.0], []]


def test_corrections_take_the_first_stop(spark):
    text = "Manual correction: home world is Proxima-b; declared is not. Manual correction: declared purpose is field repair"
    assert one(spark, t=text.replace(". Manual", ".\nManual")).select(pages.corrections(F.col("t")).alias("c")).first().c == {"home_world": "Proxima-b", "declared_purpose": "field repair"}


def test_score_of_a_case(spark):
    fields = {"visa_class": 5, "risk_flags": 8}
    base = {"case_id": "c", "present": True, "truth_adjudication": "denied", "pred_adjudication": "APPROVED", "pred_confidence": "0.9", "unrecoverable": "risk_flags", "traps": "unknown", "truth_visa_class": "XW-1", "pred_visa_class": " xw-1", "truth_risk_flags": "a", "pred_risk_flags": "a", "pred_fee_status": "paid"}
    r = evaluate.case_scores(one(spark, **base), fields).first()
    assert [tuple(x) for x in r.field_results] == [("visa_class", "matched", 5, 5), ("risk_flags", "not_scorable_unrecoverable", 0, 0)]
    assert (r.extraction_raw, r.extraction_max_raw, r.classification_raw, r.catastrophic_false_approval, r.traps_present) == (5, 5, -4, True, True) and abs(r.confidence_brier - 0.81) < 1e-12
    r = evaluate.case_scores(one(spark, **(base | {"present": False})), fields).first()
    assert (r.pred_adjudication, r.extraction_raw, r.extraction_max_raw, r.classification_reason, r.confidence, r.confidence_brier, r.adjudication_valid) == ("MISSING", 0, 5, "missing_case", None, None, None)


def test_error_rows(spark):
    e = spark.createDataFrame([("c", "risk_flags", "b|a|b"), ("c", "visa_class", " "), ("d", "visa_class", "XW-1")], "case_id string, field string, value string")
    r = spark.createDataFrame([("c", "risk_flags", "a| b", "corroborated", "m"), ("c", "visa_class", "XW-2", "single_source", "m")], "case_id string, field string, resolved_value string, status string, resolution_method string")
    o = spark.createDataFrame([("c", "visa_class", 2, "fee_receipt", "ocr", "xw2", None)], "case_id string, field string, page_number int, document_type string, text_source string, raw_value string, normalized_value string")
    got = {(x.case_id, x.field): x for x in check.error_rows(e, r, o).collect()}
    assert set(got) == {("c", "visa_class"), ("d", "visa_class")} and got["c", "visa_class"].error_category == "unexpected_prediction" and got["d", "visa_class"].resolution_status == "field_absent"
    assert json.loads(got["c", "visa_class"].all_observations) == [{"page": 2, "document_type": "fee_receipt", "text_source": "ocr", "raw_value": "xw2", "normalized_value": None}] and got["d", "visa_class"].all_observations == "[]"


def test_more_sources_and_sinks(spark, tmp_path):
    (tmp_path / "m.csv").write_text('case_id,x\n" MIB-000001 ",1\n,2\nMIB-000002,3\n')
    assert [r.case_id for r in readers.manifest_ids(spark, f"{tmp_path}/m.csv").collect()] == ["MIB-000001", "MIB-000002"]
    assert readers.csv_rows(spark, f"{tmp_path}/m.csv", multiline=False).count() == 3
    (tmp_path / "x.jsonl").write_text('{"case_id": "a", "confidence": 0.5}\n\n{"case_id": \n')
    with pytest.raises(Exception, match="malformed line"):
        readers.jsonl_rows(spark, f"{tmp_path}/x.jsonl").collect()
    assert [(r.line, r.value) for r in readers.bad_lines(spark, f"{tmp_path}/x.jsonl").collect()] == [(3, '{"case_id": ')]
    rows = spark.createDataFrame([(2, None, "x"), (1, "b", "x")], "c int, a string, k string")
    writers.write_json(rows, f"{tmp_path}/j", pretty=False)
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/j").collect()) == ['{"a":"b","c":1,"k":"x"}', '{"a":null,"c":2,"k":"x"}']
    writers.write_diagnostics(rows, f"{tmp_path}/d", ["k"])
    assert json.loads(spark.read.text(f"{tmp_path}/d").first().value) == {"count": 2, "k": "x", "results": [{"a": None, "c": 2}, {"a": "b", "c": 1}]}
    files = spark.createDataFrame([("MIB-1(2)", "/b"), ("MIB-1(1)", "/a"), ("MIB-2", "/c"), ("MIB-22", "/d")], "stem string, path string")
    got = readers.located(spark.createDataFrame([("MIB-1",), ("MIB-2",), ("MIB-3",)], "case_id string"), files)
    assert sorted(map(tuple, got.collect())) == [("MIB-1", "/a"), ("MIB-2", "/c"), ("MIB-3", None)]


def test_orders(spark):
    s = spark.createDataFrame([("b", 2.0, 5), ("a", 2.0, 5), ("c", 9.0, 1)], "case_id string, top_priority double, weighted int")
    assert [r.case_id for r in triage.by_urgency(s).collect()] == ["c", "a", "b"]


def test_files_and_text_layers(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    assert tuple(readers.file_sizes(spark, str(tmp_path)).first()) == (2, 6) and tuple(readers.file_sizes(spark, str(tmp_path), "*.bin").first()) == (1, 5)

    def reader(content):
        box = {"x0": 0.0, "y0": 0.0, "x1": 9.0, "y1": 9.0}
        return [{"width": 100.0, "height": 50.0, "text": w, "words": [w], "blocks": 1, "spans": [{"text": w, "color": 0, "bbox": box}, {"text": "hidden", "color": 0xFFFFFF, "bbox": box}]} for w in content.decode().split()]

    files = spark.createDataFrame([("c", bytearray(b"one two")), ("d", None)], "case_id string, content binary")
    got = readers.text_layers(files, reader).withColumn("seen", pages.visible_text(F.col("spans"), F.col("width"), F.col("height"))).orderBy("page_number").collect()
    assert [(r.case_id, r.page_number, r.seen) for r in got] == [("c", 1, "one"), ("c", 2, "two")]


def test_counts_of_nothing(spark):
    assert tuple(evaluate.index_counts(spark.createDataFrame([], "k string"), "k").first()) == (0, 0, 0, 0)


def test_pages_stay_rows_while_labels_are_searched(spark):
    text = F.concat(F.lit("Foe Status: paid Case ID: MIB-"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(" Fee Status: waived"))
    p = spark.range(50).select(F.col("id").alias("_page"), text.alias("text"), F.lit("fee_receipt").alias("kind"), F.array(F.lit("fee_status"), F.lit("case_id")).alias("wanted"))
    found = labelled.fields_by_labels(p)
    assert {r._page: r.loose for r in found.collect()} == {i: {"fee_status": "paid", "case_id": f"MIB-{i:06d}"} for i in range(50)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
