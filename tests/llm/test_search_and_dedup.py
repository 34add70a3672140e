"""Exact search and near-duplicates against brute force."""

import collections
import fractions
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import neardup, topk


def test_topk(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=6).round(2).tolist()) for i in range(230)]
    rows += [(300, rows[5][1]), (301, rows[5][1]), (302, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (303, [math.nan] * 6), (304, [math.inf] * 6), (305, None), (None, [1.0] * 6), (400, [1.0, 2.0]), (401, [3.0, 1.0]), (200, rows[200][1]), (500, [1e30] * 6), (501, [1.7e308, -1.7e308, 0.5, 0.0, 0.0, 0.0]), (600, [-1.7e308, 1.0, 1e-9, 5e307, 0.25, 0.0]), (601, [1e12, -1e12, 1e-3, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    got = topk.exact_topk(df, F.pmod(F.col("vec_id"), F.lit(100)) == 0).collect()
    ok = [(i, [math.floor(1024 * fractions.Fraction(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    expected = []
    for q, v in {i: v for i, v in ok if i % 100 == 0}.items():
        found = sorted((-clip(sum(a * b for a, b in zip(v, w, strict=True))), i) for i, w in ok if i != q and len(w) == len(v))[:10]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found)]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_topk_in_small_tiles_and_a_deep_tree(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.array(*[(F.hash("id", F.lit(j)) % 7 / 3).cast("float") for j in range(4)]).alias("embedding")).repartition(9)
    whole = sorted(map(tuple, topk.exact_topk(df, F.col("vec_id") % 100 == 0).collect()))
    monkeypatch.setattr(topk, "FAN_IN", 2)
    monkeypatch.setattr(topk, "TILE", 16)
    monkeypatch.setattr(topk, "PASS_COMPONENTS", 12)
    assert sorted(map(tuple, topk.exact_topk(df, F.col("vec_id") % 100 == 0).collect())) == whole and len(whole) == 40
    assert topk.exact_topk(df.limit(0), F.lit(True)).count() == 0


def test_topk_of_many_queries_reads_the_candidates_once(spark):
    """10,000 queries are one pass, and the plan is that of a single query."""
    rows = spark.range(12_000).select(F.col("id").alias("vec_id"), F.array(*[(F.hash("id", F.lit(j)) % 50 / 17).cast("double") for j in range(4)]).alias("embedding"))
    rows.repartition(2).write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/vectors.parquet")
    df = spark.read.parquet(path)
    many, one = topk.exact_topk(df, F.col("vec_id") < 10_000, k=3), topk.exact_topk(df, F.col("vec_id") == 17, k=3)
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (many, one)]
    assert [p.count("FileScan") for p in plans] == [1, 1] and plans[0].count("\n") == plans[1].count("\n")
    assert many.count() == 30_000 and many.where("query_id = 17").orderBy("rank").collect() == one.orderBy("rank").collect()


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())


def brute(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least.get(find(i), d), d is None or least.get(find(i), d) == d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)) if d is not None)


def corpus(seed=4):
    """Copies, chains whose ends are far apart, near misses, short and empty texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(r.choice([6, 40, 120, 400]))]
        rows.append(" ".join(base))
        chain = list(base)
        for _ in range(r.randint(0, 12)):
            for _ in range(max(1, len(chain) // r.choice([30, 60, 90]))):
                chain[r.randrange(len(chain))] = word()
            rows.append(" ".join(chain))
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, len(base) // 20 + 1])):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy).upper() if r.random() < 0.3 else " \n\t".join(copy))
    rows += [None, "", " \n", "one two", "One  TWO", "one two three", " x y", "x " * 20000]
    ids = r.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("tile", [neardup.TILE, 4])
def test_neardup(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    rows = corpus()
    rows += rows[:3]
    rows += [(rows[3][0], rows[9][1]), (rows[4][0], "an id used again for another text")]
    df = spark.createDataFrame([(i, t, "x", b"y") for i, t in rows], "doc_id long, text string, comp string, regs binary").repartition(3)
    got = neardup.linked_components(df, width=4).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_neardup_of_a_hot_row(spark):
    """2,000 equal rows of one id, 1,500 near copies of one text, and texts that share half of their words with it."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = [(5, " ".join(base))] * 2000
    for i in range(1500):
        near = list(base)
        near[r.randrange(120)] = word()
        rows.append((100 + i, " ".join(near)))
    rows += [(5000 + i, " ".join(base[:60] + [word() for _ in range(60)])) for i in range(200)]
    got = neardup.linked_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == len(rows) and sum(x.component_id == 5 for x in got) == 3500
    assert all(x.component_id == x.doc_id and x.kept for x in got if x.doc_id >= 5000)
    assert neardup.WIDTH == 4 and sum(x.kept for x in got if x.doc_id < 5000) == 2000


def test_neardup_edges(spark):
    schema = "doc_id long, text string"
    assert neardup.linked_components(spark.createDataFrame([], schema)).count() == 0
    got = neardup.linked_components(spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (7, "A b c d e"), (8, None)], schema), width=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, [(None, 2, 7, True), (None, 2, 7, True), (7, 2, 7, True), (8, 0, 8, True)])) or {(r.doc_id, r.component_id, r.kept) for r in got} == {(None, 7, True), (7, 7, True), (8, 8, True)}


def test_registers_merge_and_estimate():
    r = np.random.default_rng(2)
    for n, j in ((40, 0.8), (2000, 0.5), (20000, 0.9)):
        both = int(2 * n * j / (1 + j))
        pool = r.integers(0, 2**63, 2 * n, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n - both : 2 * n - both])
        ra, rb, ru = neardup.registers([a, b, np.union1d(a, b)])
        assert (np.maximum(ra, rb) == ru).all()
        est = neardup.estimated(np.array([len(a)]), np.array([len(b)]), np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]))[0]
        assert abs(est - j) < 0.15
    assert (neardup.registers([np.zeros(0, np.uint64)]) == 0).all()


@pytest.mark.parametrize("few", [neardup.FEW_EDGES, 5, 0])
def test_components_of_a_long_chain(spark, monkeypatch, few):
    monkeypatch.setattr(neardup, "FEW_EDGES", few)
    e = spark.range(60).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("a"), F.concat(F.lit("v"), F.lpad((F.col("id") + 1).cast("string"), 3, "0")).alias("b"))
    got = neardup.components(e.unionByName(spark.createDataFrame([("x", "y")], "a string, b string"))).collect()
    assert collections.Counter(r.comp for r in got) == {"v000": 61, "x": 2}
