"""Packing, BPE, classifiers, page extraction, pipeline: round trips, held-out accuracy, edge cases."""

import hashlib
import html.parser
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from caseloom.llm import bpe, language, neardup, packing, pages, quality, tokens

SF = "/root/testdata/sf0.001"
BYTE_BPE, MULTI = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
HARD = [
    (1, None), (2, ""), (3, " "), (4, "a  b \n c\t\n\n d "), (5, "it's we'll 123 45x!?"), (5, "it's we'll 123 45x!?"), (None, "null id"), (7, "՘֋ word \x1c\x1f   x　y  z"), (8, "\U0001f600 กำ 中文字 ру́сский"),
    (9, "<|endoftext|> stays text"), (10, "lorem ipsum " * 9000), (11, "a" * 3000), (12, "x\x00y"),
]


def frame(spark, rows=HARD):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, size int, block string").repartition(3)


def test_json_encoder():
    whole, mine = Tokenizer.from_file(BYTE_BPE), tokens.JsonEncoder(BYTE_BPE)
    r = random.Random(1)
    texts = [t or "" for _, t in HARD] + ["".join(r.choice("ab  \n\t'sé§1😀中.,Ж") for _ in range(60)) for _ in range(300)]
    assert [mine.encode(t) for t in texts] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing(spark):
    whole = Tokenizer.from_file(BYTE_BPE)
    got = packing.packed(frame(spark), BYTE_BPE).collect()
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.SEQUENCE
    expected = []
    for i, t in HARD:
        x = whole.encode(t or "", add_special_tokens=False).ids + [1]
        expected += [((i is None, i or 0), at, len(x[at : at + 2048]), zlib.crc32(np.array(x[at : at + 2048], "<u4").tobytes()), len(x)) for at in range(0, len(x), 2048)]
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(expected)
    assert packing.packed(frame(spark, []), BYTE_BPE).count() == 0


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_packing_plan_is_tight(seed):
    r = np.random.default_rng(seed)
    sizes = np.minimum(256, (r.lognormal(3.5, 1.3, 3000)).astype(int) + 1)
    demand = np.bincount(sizes - 1, minlength=256)
    runs = packing.plan(demand)
    used = {}
    for s, table in runs.items():
        ends = np.append(table[1:, 0], demand[s])
        for (first, seq, per), end in zip(table.tolist(), ends.tolist(), strict=True):
            for k in range(end - first):
                used[seq + k // per] = used.get(seq + k // per, 0) + s + 1
    assert max(used.values()) <= 256 and sum(used.values()) == int((demand * np.arange(1, 257)).sum())
    assert len(used) <= 1.01 * -(-sum(used.values()) // 256) + 2


def test_packing_plans_beside_a_started_session(spark):
    """With bins enough for many steps of the simplex; the inverse of a basis is the one of numpy."""
    assert spark.range(1000).selectExpr("sum(id) AS s").first().s == 499500
    r = np.random.default_rng(9)
    demand = np.bincount(r.integers(0, 256, 3000), minlength=256)
    assert sum(len(t) for t in packing.plan(demand).values()) >= 200
    a = r.normal(size=(40, 40))
    assert np.allclose(packing._inverted(a) @ a, np.eye(40))


def test_bpe(spark):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tokens.ranks(MULTI), special_tokens={})
    expected = []
    for i, t in HARD:
        ids = enc.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    q = bpe.encoded(frame(spark), MULTI, P.PATTERN)
    got = q.collect()
    plan = q._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("MapInPandas") == 1  # texts are cut once
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert bpe.encoded(frame(spark, []), MULTI, P.PATTERN).count() == 0


def test_decoding_joins_the_token_table(spark):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tokens.ranks(MULTI), special_tokens={})
    rows = [(i, enc.encode_ordinary(t or ""), 1) for i, t in HARD] + [(99, None, 1)]
    got = bpe.decoded(spark.createDataFrame(rows, "doc_id long, ids array<int>, bytes int").repartition(3), MULTI).collect()
    assert sorted((str(r.doc_id), bytes(r.bytes)) for r in got) == sorted((str(i), enc.decode_bytes(x or [])) for i, x, _ in rows)


def test_cutter_loses_nothing():
    cutter = bpe.Cutter(P.PATTERN)
    assert all("".join(cutter.words(t)) == t for _, t in HARD if t)


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs, model).collect()}
    truth = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if held_out(r.doc_id)]
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    assert np.mean([p == y for p, y in truth]) > 0.95
    hard = quality.scored(frame(spark), model).collect()
    assert len(hard) == len(HARD) and all(0 <= r.score <= 1 for r in hard)
    assert quality.scored(frame(spark, []), model).count() == 0
    none = quality.fit(docs, labels.limit(0))
    assert none is None and {r.score for r in quality.scored(frame(spark), none).collect()} == {0.5}
    assert quality.accepted(frame(spark), None).count() == len(HARD)


def test_attention_gradient():
    """The analytic step lowers the loss on a toy problem where one passage of a bag decides."""
    r = np.random.default_rng(0)
    counts = r.integers(1, 6, 300)
    x = r.normal(0, 1, (int(counts.sum()), 8)).astype(np.float32)
    y = np.maximum.reduceat(x[:, 0], np.cumsum(counts) - counts) > 0.8
    m = quality.train(x, counts, y.astype(np.float32))
    p = quality._forward(m, x, counts)["p"]
    assert ((p > 0.5) == y).mean() > 0.9


def plain_quality(m, text):
    """The score of one text, passage by passage and unit by unit."""
    data, passages, seen = (text or "").encode(), [], set()
    for at in range(0, max(1, len(data)), quality.PASSAGE):
        part = data[at : at + quality.PASSAGE]
        f = np.zeros(quality.N_FEATURES)
        before = 5 if at == 0 else quality.COARSE[data[at - 1]]
        for byte in part:
            f[before * quality.N_COARSE + quality.COARSE[byte]] += 1
            f[quality.N_COARSE**2 + quality.FINE[byte]] += 1
            before = quality.COARSE[byte]
        f = np.sqrt(f / max(len(part), quality.SHORT))
        words = part.split()
        f[-3], f[-2], f[-1] = len(part) / quality.PASSAGE, len(part) == 0, 1 - len(set(words)) / len(words) if len(words) > 8 else 0
        passages.append(f)
    at = 0
    for line in data.split(b"\n") if data.count(b"\n") > 1 else []:
        if len(line) > 3:
            passages[at // quality.PASSAGE][-4] += len(line) / quality.PASSAGE * (line in seen)
            seen.add(line)
        at += len(line) + 1
    hs, es = [], []
    for f in passages:
        f[-4] = min(4, f[-4])
        h = np.tanh((f - m["mean"]) * m["scale"] @ m["W"] + m["b"])
        hs.append(h)
        es.append(float((np.tanh(h @ m["V"]) / (1 + np.exp(-(h @ m["U"])))) @ m["w"]))
    att = np.exp(np.array(es) - max(es))
    z = (att / att.sum()) @ np.array(hs)
    return 1 / (1 + np.exp(-float(z @ m["o"] + m["c"][0])))


def test_quality_scores_match_a_plain_forward_pass():
    texts = [None, "", "a", "Two lines.\nTwo lines.\nTwo lines.\nand more é!", "x" * 5000, "word and word, " * 9000, *[t for _, t in HARD]]
    x, counts = quality.passages([t or "" for t in texts])
    m = quality.train(x, counts, np.arange(len(texts)) % 2.0)
    one = [float(quality.score(m, [t])[0]) for t in texts]
    assert np.allclose(quality.score(m, texts), one, atol=1e-5)
    assert np.allclose(one, [plain_quality(m, t) for t in texts], atol=1e-4)


def test_a_sampled_id_brings_one_row(spark):
    docs = spark.range(4000).selectExpr("id % 2 AS doc_id", "concat('text ', id) AS text", "'en' AS lang").repartition(4)
    seen = []
    fitted = quality._fitted, language._fitted
    try:
        quality._fitted = language._fitted = lambda rows: len(rows)
        seen = quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(2)], "doc_id long, quality int")), language.fit(docs)
    finally:
        quality._fitted, language._fitted = fitted
    assert seen == (sum(not held_out(i) for i in range(2)),) * 2


def test_language(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 600)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identified(docs, model).collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.95
    hard = {r.doc_id: r for r in language.identified(frame(spark), model).collect()}
    assert all(hard[i].lang_pred == "und" and hard[i].score == 0 for i in (1, 2, 3)) and hard[11].lang_pred in model["langs"]
    assert language.identified(frame(spark, []), model).count() == 0
    assert {r.lang_pred for r in language.identified(frame(spark), None).collect()} == {"und"}


def random_network(r, languages=2):
    H = language.HIDDEN
    m = {"E": r.normal(0, 0.5, (256, language.EMBED)), "O": r.normal(0, 0.5, (2 * H, languages)), "o": r.normal(0, 0.3, languages)}
    for d in "fb":
        m |= {"Wx" + d: r.normal(0, 0.3, (language.EMBED, 3 * H)), "bx" + d: r.normal(0, 0.3, 3 * H), "Wh" + d: r.normal(0, 0.3, (H, 3 * H))}
    return m


def test_gru_gradient():
    """Backpropagation through time against finite differences."""
    data, langs = [b"abc", b"de", b"fg hi"], np.array([0, 1, 0])
    m = random_network(np.random.default_rng(3))
    x, lengths = language._padded(data)

    def loss():
        both, mask, *_ = language._states(m, x, lengths, True)
        logp = language._log_softmax(both @ m["O"] + m["o"])
        return -float((logp[:, np.arange(3), langs] * mask).sum() / mask.sum())

    grad = language._gradients(m, x, lengths, langs)
    for k, i in (("Whf", (2, 5)), ("Whb", (1, 25)), ("Wxf", (3, 7)), ("bxb", (20,)), ("E", (ord("b"), 2)), ("O", (3, 1)), ("o", (0,))):
        old = m[k][i]
        m[k][i] = old + 1e-4
        up = loss()
        m[k][i] = old - 1e-4
        down = loss()
        m[k][i] = old
        assert abs((up - down) / 2e-4 - float(grad[k][i])) < 1e-5, k


def plain_labels(m, data):
    """Log-probabilities of every position of one run of bytes, step by step."""
    H, sigmoid, states = language.HIDDEN, lambda v: 1 / (1 + np.exp(-v)), {}
    for d, run in (("f", data), ("b", data[::-1])):
        h, seen = np.zeros(H), []
        for byte in run:
            x, y = m["E"][byte] @ m["Wx" + d] + m["bx" + d], h @ m["Wh" + d]
            z, r = sigmoid(x[:H] + y[:H]), sigmoid(x[H : 2 * H] + y[H : 2 * H])
            h = z * h + (1 - z) * np.tanh(x[2 * H :] + r * y[2 * H :])
            seen.append(h)
        states[d] = seen if d == "f" else seen[::-1]
    e = np.concatenate((states["f"], states["b"]), 1) @ m["O"] + m["o"]
    return e - np.log(np.exp(e).sum(1, keepdims=True))


def test_language_matches_a_plain_forward_pass(monkeypatch):
    """Windows, both layouts of the network, pooling and the rule for und."""
    monkeypatch.setattr(language, "OWN", 20)
    monkeypatch.setattr(language, "EDGE", 6)
    monkeypatch.setattr(language, "GROUP", 5)
    m = random_network(np.random.default_rng(8), 3) | {"langs": ["aa", "bb", "cc"]}
    texts = ["a", "der Hund läuft", "one two three four five six seven eight nine ten", "été " * 40, "中文字 " * 9, "x" * 41]
    names, scores = language.predict(m, [*texts, None, "", "12 ½ ² Ⅷ _ -", "ªb"])
    assert names[-4:-1] == ["und"] * 3 and list(scores[-4:-1]) == [0, 0, 0] and names[-1] != "und"
    for text, name, score in zip(texts, names, scores, strict=False):
        data, total = text.encode(), np.zeros(3)
        for at in range(0, len(data), 20):
            lead = min(6, at)
            total += plain_labels(m, data[at - lead : at + 26])[lead : lead + 20].sum(0)
        e = np.exp(total / len(data) * min(language.EVIDENCE, max(1, len(data) / language.GRAIN)))
        assert name == m["langs"][int(e.argmax())] and abs(score - e.max() / e.sum()) < 1e-4
    x, lengths = language._padded([t.encode() for t in texts])
    both, *_ = language._states(m, x, lengths, False)
    steps = np.ascontiguousarray(x.T).astype(np.intp)
    fast = language._logits(m, "f", steps, lengths) + language._logits(m, "b", steps, lengths)
    for i, n in enumerate(lengths):
        assert np.allclose(fast[:n, :, i], (both @ m["O"])[:n, i], atol=1e-4)


PAGES = [
    (1, None, ""), (2, "", ""), (3, "just text &amp; more", "just text & more"), (4, "<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>Title &eacute;</h1><p>One <b>two</b>three.<br>Four</p><p>Five&nbsp;six</p></article><footer>&copy; me</footer></body></html>", "Title é One twothree. Four Five six"),
    (4, "<article><p>Cut off here &am", "Cut off here &am"), (6, "<body><article><p>Kept text goes here.</p><script>var a = '<p>no</p>';</script><!-- no --><style>p{}</style></article><section class='comments'><p>Nice post, thanks!</p></section><form><p>Your mail</p></form></body>", "Kept text goes here."),
    (7, "<div class='cookie-notice'><p>We use cookies.</p></div><article>" + "<p>Long text, it goes on.</p>" * 3000 + "</article>", " ".join(["Long text, it goes on."] * 3000)),
]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("<html><head><title>T</title><body><article><p>Hello there, this is text.</p></article>", "Hello there, this is text."),
        ("<head><title>T</title><meta charset=x><article><p>Hello there, this is text.</p></article>", "Hello there, this is text."),
        ("<html><head><title>T</title><style>p{}</style></head><body><article><p>Hello there.</p></article></body></html>", "Hello there."),
        ("<article><p>One here.</p><svg class='i'/><p>Two here.</p><svg class='j'><text>drawn</text></svg><p>Three here.</p></article>", "One here. Two here. drawn Three here."),
        ("<article><p>One here.</p><svg viewBox='0'><p>Two here.</p></article>", "One here. Two here."),
        ("<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here.</p></article>", "Energy is E=m here."),
        ("<article><p title=it's>One here.</p><p data-x=a\"b'c>Two here.</p></article>", "One here. Two here."),
        ("<article><p>See if a <b and c</p><p>Two here, as well.</p></article>", "See if a Two here, as well."),
        ("<article><p>One here.<object data='x'>No plugin, sorry.</object> <video><source src=x>No player.</video><canvas>Bars.</canvas></p></article>", "One here.No plugin, sorry. No player.Bars."),
        ("<article><table><thead><tr><th>A one<th>B two<tbody><tr><td>One here.</div><td>Two here.<tfoot><tr><td>Three.</table><p>Four here.</article>", "A one B two One here. Two here. Three. Four here."),
        ("<article><!--><p>One here.</p><!-- a --!><p>Two here.</p><script>1 < 2 </p></script ><p>Three here.</p></article>", "One here. Two here. Three here."),
        ("<article><h2>One head<h3>Two head</h3><p>Text here, <a href='x>y'>linked</a>.</p><img alt='a > b' src=/x/></article>", "One head Two head Text here, linked."),
        ("<article><p>1 < 2 and 3 > 2, <3 &lt;b&gt;</p></article>", "1 < 2 and 3 > 2, <3 <b>"),
        ("<article><p>One here.</p><button>no</button><select><p>Two here.</p></article>", "One here. Two here."),
    ],
)
def test_pages_without_end_tags(source, expected):
    assert pages.main_text(source, pages.default_model()) == expected


class Plain(html.parser.HTMLParser):
    """The text of article elements by another parser, blocks apart."""

    def __init__(self):
        super().__init__()
        self.depth, self.hidden, self.parts = 0, 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.hidden += tag in ("script", "style")
        if tag not in pages.INLINE:
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.hidden -= tag in ("script", "style")
        if tag not in pages.INLINE:
            self.parts.append(" ")

    def handle_data(self, data):
        if self.depth and not self.hidden:
            self.parts.append(data)


def test_pages_against_another_parser():
    """Random articles with every kind of attribute and inline markup, by Python's own parser; and the pages of a table."""
    r = random.Random(12)
    word = lambda: r.choice(["alpha", "beta,", "gamma.", "R&amp;D", "caf&eacute;", "x&#39;s", "1 < 2", "a&nbsp;b", "end;"])
    attrs = lambda: r.choice(["", " class=x", " title='it is > that'", ' data-a="<b>"', " hidden-not", " href=/a/b?c=d&e", " a=1  b = '2'", " id=it's"])
    words = lambda n: " ".join(word() for _ in range(n))
    inline = lambda: f"<{(t := r.choice(['b', 'i', 'a', 'em', 'code', 'math', 'span']))}{attrs()}>{words(2)}</{t}>"
    for _ in range(200):
        body = "".join(f"<{(t := r.choice(['p', 'p', 'div', 'h2', 'blockquote', 'li']))}{attrs()}>{words(r.randint(2, 12))}{inline()}{words(2)}{r.choice(['<br>', '<br/>', '', '<!-- c -->', '<script>if (1<2) x()</script>'])}</{t}>\n" for _ in range(r.randint(1, 9)))
        source = f"<!DOCTYPE html><html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article>{body}</article><footer>&copy; us</footer></body></html>"
        plain = Plain()
        plain.feed(source)
        page = pages.Page(source)
        inside = [False] * len(page.tags)
        for i in range(1, len(page.tags)):
            inside[i] = inside[page.parent[i]] or page.tags[i] == "article"
        assert " ".join(text for i, text in page.runs if inside[i]) == " ".join("".join(plain.parts).split()) == pages.main_text(source, pages.default_model())
    for (source,) in duckdb.sql(f"select html from read_parquet('{SF}/pages.parquet')").fetchall():
        plain = Plain()
        plain.feed(source)
        plain.close()
        assert pages.main_text(source, pages.default_model()) == " ".join("".join(plain.parts).split())


def test_pages(spark):
    model = pages.default_model()
    df = spark.createDataFrame([(i, "u", h, "x") for i, h, _ in PAGES], "page_id long, url string, html string, text string")
    got = pages.extracted(df, model).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted((i, t) for i, _, t in PAGES)
    assert all(r.n_chars == len(r.text) and r.url == "u" for r in got)
    assert pages.extracted(df.limit(0), model).count() == 0
    right = total = 0
    for source in pages.labelled_pages(60, 77):
        y, page = pages._labels(source), pages.Page(re.sub(r'\sdata-y="[01]"', "", source))
        p = pages.marginals(page, model)
        right += sum((p[i] > 0.5) == bool(y[i]) for i, _ in page.runs)
        total += len(page.runs)
    assert right / total > 0.97


def test_tree_messages_are_exact():
    page = pages.Page("<div><p>a</p><section><p>b</p></section></div>")
    feats = [[f"n{i}"] for i in range(len(page.tags))]
    r = random.Random(5)
    w = {f"n{i}": r.uniform(-1, 1) for i in range(len(page.tags))} | {f"{e}:{a}{b}": r.uniform(-1, 1) for e in ("section", "leaf") for a in (0, 1) for b in (0, 1)}
    weight, n = [], len(page.tags)
    for code in range(2**n):
        y = [code >> i & 1 for i in range(n)]
        e = sum(w[f"n{i}"] * y[i] for i in range(n)) + sum(w[f"{pages.edge(page.tags[i])}:{y[page.parent[i]]}{y[i]}"] for i in range(1, n))
        weight.append((np.exp(e), y))
    total = sum(x for x, _ in weight)
    exact = [sum(x for x, y in weight if y[i]) / total for i in range(n)]
    assert np.allclose(pages.marginals(page, w, feats), exact)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("kept", F.lit("x"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "neardup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            out = spark.createDataFrame(out.collect(), docs.schema)
            if name == "neardup":
                kept = {r.doc_id for r in neardup.linked_components(docs).where("kept").collect()}
                assert {r.doc_id for r in out.collect()} == kept
            assert 0 < out.count() <= docs.count()
            docs = out
        else:
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def plain_language(m, text):
    """Language and score of one text, window by window and step by step."""
    data = (text or "").encode()
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    total = np.zeros(len(m["langs"]))
    for at in range(0, len(data), language.OWN):
        lead = min(language.EDGE, at)
        total += plain_labels(m, data[at - lead : at + language.OWN + language.EDGE])[lead : lead + language.OWN].sum(0)
    e = np.exp((x := total / len(data) * min(language.EVIDENCE, max(1, len(data) / language.GRAIN))) - x.max())
    return m["langs"][int(e.argmax())], float(e.max() / e.sum())


def plain_groups(rows):
    """The least id of each component of near-duplicates, by all pairs."""
    words = lambda t: re.findall("[^\x20\x09-\x0d]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set()) for i, w in ((i, words(t)) for i, t in rows)}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: root(i) for i in sets}


def test_pipeline_against_brute_force(spark, tmp_path):
    """The whole pipeline on a fixture of short documents, each stage by plain loops over the same models."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 1500")
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality.fit(docs, labels)
    good = {i for i, t in texts.items() if plain_quality(model, t) >= 0.3}
    known = docs.where(F.col("doc_id").isin(*good))
    assert {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).collect()} == good
    model = language.fit(known)
    told = {i for i in good if (x := plain_language(model, texts[i]))[0] != "und" and x[1] >= 0.3}
    assert {r.doc_id for r in corpus_pipeline.language_stage(spark, known, str(tmp_path)).collect()} == told
    groups = plain_groups([(i, texts[i]) for i in sorted(told)])
    kept = {i for i, first in groups.items() if first == i}
    assert len(kept) < len(told) < len(texts)
    whole, expected = Tokenizer.from_file(BYTE_BPE), []
    for i in kept:
        x = whole.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        expected += [(i, at, len(x[at : at + 2048]), zlib.crc32(np.array(x[at : at + 2048], "<u4").tobytes()), len(x)) for at in range(0, len(x), 2048)]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(expected)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert len(places) <= -(-sum(r.length for r in got) // 2048) + 2


def test_very_long_texts(spark):
    """A text of over a million bytes goes through every model whole."""
    rows = [(1, "the quick brown fox jumps over it. " * 40_000), (2, "x" * 1_200_000), (3, "short")]
    df = frame(spark, rows)
    scored = {r.doc_id: r.score for r in quality.scored(df, None).collect()}
    assert set(scored) == {1, 2, 3}
    x, counts = quality.passages([t for _, t in rows])
    assert counts.tolist() == [-(-len(t) // quality.PASSAGE) for _, t in rows] and np.isfinite(x).all()
    m = {k: v.astype(np.float32) for k, v in random_network(np.random.default_rng(2), 2).items()} | {"langs": ["aa", "bb"]}
    sums = language.position_sums(m, [t.encode() for _, t in rows[:1]])
    again = language.position_sums(m, [rows[0][1][:70_000].encode()])
    assert np.allclose(sums / len(rows[0][1]), again / 70_000, rtol=1e-3)
    assert {r.doc_id for r in language.identified(df, m).collect()} == {1, 2, 3}


def test_pipeline_takes_hard_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(i, t, "en" if i != 8 else None, None, None) for i, t in HARD]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                docs = spark.createDataFrame(out.collect(), schema)
            else:
                assert out.count() >= docs.count() * bool(rows)


def test_neardup_stage_tells_rows_apart(spark):
    text, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(5, text, "a"), (5, text, "b"), (None, text, "c"), (3, text, "d"), (5, other, "e"), (None, other, "f"), (None, "", "g"), (None, "", "h")]
    got = corpus_pipeline.neardup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()
    assert sorted(r.source for r in got) == ["d", "e", "g", "h"]
