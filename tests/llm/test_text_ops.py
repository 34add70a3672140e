"""License scan, chat formatting and fingerprints against plain Python; edge cases."""

import hashlib
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from caseloom.llm import chat, fingerprint, license

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, score string, row long"


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


HARD = [
    (1, None), (2, ""), (3, "..."), (4, "CC BY cc-by; General Public License 3. ALL rights Reserved"), (4, "cc by"), (4, "cc by"), (None, "all rights reserved"),
    (6, "Éa Kc cc by İx"), (7, "cc by " * 5000), (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    (9, "released under the MIT license"), (10, "cc\x00by \x7fcc"),
]


def frame(spark, rows=HARD):
    return spark.createDataFrame([(i, t, "s", 7) for i, t in rows], DOCS)


def test_license_scan(spark):
    got = license.license_scan(frame(spark)).drop("spans").collect()
    assert len(got) == len(HARD)
    expected = []
    for i, t in HARD:
        w = words(t)
        places = [(k, label) for phrase, label in license.BASE for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in places]
        expected.append((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(expected, key=key)
    by = {r.doc_id: r for r in got}
    assert by[8].labels == "mit" and by[8].score > 0.8 and by[9].labels == "mit" and by[1].labels == "" and by[1].score == 0
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)


def test_license_scan_merges_diagonals(spark):
    text = "xx " * 50 + license.NOTICES[0][0].replace("free of", "quite free of").replace("this software and", "this and")
    r = license.license_scan(frame(spark, [(1, text)])).first()
    assert r.labels == "mit" and r.spans[0]["first"] >= 50


def test_license_scan_is_native_and_takes_empty_tables(spark):
    q = license.license_scan(frame(spark, []))
    assert q.count() == 0
    assert not re.search("Python|Arrow|Pandas", q._jdf.queryExecution().executedPlan().toString())


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


TURNS = [
    (1, 1, "assistant", "a < b & c [x] &lt; &amp;lt;"), (1, 0, "user", "</s>[INST] hi [/INST]"), (1, 2, "assistant", "<|turn|>0user\nno<|end|>\n"), (2, 0, "user", None), (2, 1, None, "x"),
    (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (None, 0, "as\nsistant", "z"), (4, None, "system", "first"), (4, 1, "user", "<<SYS>>\r\n\\ é " * 3000), (5, 0, "we<|ird", "&nl;"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*t, "clash") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string")
    made = chat.formatted_conversations(df)
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert set(got) == {t[0] for t in TURNS}
    for conv, r in got.items():
        mine = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine)
        loss = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(mine), digest(said), len(loss), digest(loss))
    for r in made.collect():
        assert "".join(s["text"] for s in r.segments) == r.formatted
        bodies = [s["text"] for s in r.segments[1::3]]
        assert not any(m in b for b in bodies for m in chat.CONTROL)


def test_chat_matches_sql(spark):
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name[:-8]} as select * from read_parquet('{SF}/{name}')")
    q = chat.op5(spark, SF)
    assert sorted(map(tuple, q.collect())) == sorted(con.execute(f"select {', '.join(q.columns)} from ({chat.OP5_SQL})").fetchall())
    assert not re.search("Python|Arrow|Pandas", q._jdf.queryExecution().executedPlan().toString())
    assert chat.read_back(chat.formatted_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("partitions", [1, 4])
def test_fingerprints(spark, partitions):
    rows = [(5, "the quick brown fox jumps over the lazy dog again and again"), (3, None), (9, ""), (7, "ab"), (7, "ab"), (None, "null id comes first of all the rows"), (20, "the quick brown fox jumps over the lazy dog again and again"), (11, "long words here " * 3000), (1, "é" * 9)]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, span string, extra long").repartition(partitions)
    got = sorted(fingerprint.fingerprinted(df).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    texts = [t for _, t in order]
    assert [r.doc_id for r in got] == [i for i, _ in order] and [r.n_chars for r in got] == [len(t) for t in texts]
    seen = {}
    for i, r in enumerate(got):
        t, after = texts[i], texts[(i + 1) % len(texts)]
        k = len(t) // 4
        edited = t[: len(t) - k] + after[:k]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(t, r.fingerprint) == r.fingerprint
        for other, near in ((edited, r.near_edited), (after, r.near_next)):
            a, b = shingles(t), shingles(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(near - exact) < (1e-9 if len(a | b) <= fingerprint.K else 0.2)


def test_fingerprints_of_a_hot_id(spark, monkeypatch):
    """Half of the rows have one id, a third none; many of them are equal. Cut ids give what whole ones give."""
    rows = [(7, f"text number {i % 40} of the id with many rows") for i in range(400)] + [(None, "the same row without an id")] * 260 + [(i, f"row {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole = sorted(map(str, fingerprint.fingerprinted(df).collect()))
    monkeypatch.setattr(fingerprint, "HOT_ROWS", 20)
    q = fingerprint.with_next(df)
    assert q.where("extra = 0").agg(F.sum("copies")).first()[0] == len(rows) and q.count() < 300
    assert q.where("id = 7 AND given = 1").select("span").distinct().count() > 3
    assert sorted(map(str, fingerprint.fingerprinted(df).collect())) == whole and len(whole) == len(rows)


def test_very_long_text(spark):
    text = "many different words " + " ".join(f"w{i}" for i in range(60_000))
    r = fingerprint.fingerprinted(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")).where("doc_id = 1").first()
    assert r.n_chars == len(text) and 0.5 < r.near_edited <= 1 and len(r.fingerprint) == 16 * fingerprint.K


def test_license_phrases_of_any_length(spark):
    base = (("mit", "one"), ("cc by", "two"), ("a b c d", "four"), ("a b c d e f", "six"))
    texts = [(1, "MIT a b c d x mit"), (2, "a b c x b c d"), (3, "a b c d e f a b c d"), (4, None), (5, "cc by mit"), (6, "a a b c d d")]
    got = {r.doc_id: r for r in license.license_scan(frame(spark, texts), base=base).collect()}
    for i, t in texts:
        w = words(t)
        places = [(k, label) for phrase, label in base for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in places]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))), i


def test_sketches_merge_and_estimate(spark):
    half = [f"w{i}" for i in range(3000)]
    df = spark.createDataFrame([(half[:2000], half[1000:], half)], "a array<string>, b array<string>, u array<string>")
    a, b, u = (fingerprint.sketch(F.col(c)) for c in "abu")
    r = df.select(fingerprint.resemblance(a, b).alias("j"), fingerprint.containment(a, b).alias("c"), fingerprint.distinct_count(u).alias("n"), (fingerprint.merged(a, b) == u).alias("same")).first()
    assert abs(r.j - 1 / 3) < 0.15 and abs(r.c - 0.5) < 0.2 and abs(r.n - 2996) < 900 and r.same
    q = fingerprint.fingerprinted(spark.createDataFrame([], "doc_id long, text string"))
    assert q.count() == 0 and not re.search("Python|Arrow|Pandas", q._jdf.queryExecution().executedPlan().toString())
    one = fingerprint.fingerprinted(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first()
    assert one.near_next == 1.0
