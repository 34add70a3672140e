"""Near-duplicates by SetSketch registers.

1. Every text becomes the set of its word shingles, a digest of the set, and a
   SetSketch: m registers, each the truncated logarithm of the least of
   exponentially spaced values that the set's elements draw for it. An element draws
   its values in ascending order, one register after another, and stops at the
   largest minimum so far. Registers of a union are the maxima of the registers.
2. Texts of equal sets fall together by digest; what follows sees one of each.
3. Registers are banded, and the bands are taken in groups (``GROUPS``), few bands
   first. In each bucket every component that the groups before have left is paired
   with the bucket's first member by one member of its own; the pairs' similarity is
   estimated by maximum likelihood from the counts of larger, smaller and equal
   registers together with the known set sizes, and a pair that may reach the
   threshold is verified on both full sets. Verified links are contracted at once, so
   that n near copies make about n pairs in the first group and few in the others.
4. Buckets that still hold several components have their minor members compared
   with all others, tile by tile, by the same estimate, and the most likely partners
   are verified. Buckets with more such pairs are joined to clusters, of which the
   members of such pairs alone go on; there every pair across components that may be
   a link is tested inside its tile, on full sets, and one link to each component
   reached is kept. So no link between different texts is lost to the choice of
   partners, and a group of copies never becomes all of its pairs.

Defined results: a null or empty text, or one without words, has an empty set, no
links and itself as component; a text with fewer words than a shingle is one
shingle; repeated rows are linked to each other; a row without an id takes part as
a text, has the least id it reaches (or null) and is kept; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import removed, slices, table, written
from .shingles import mix, set_key, shingle_sets

WIDTH, PERCENT = 4, 80
M, BASE, RATE, TOP = 128, 1.09, 20.0, 254
ROWS = 4  # registers per band
BANDS = M // ROWS
#: Bands by group: links of one group are contracted before the next makes its pairs.
GROUPS = (range(4), range(4, BANDS))
#: Standard deviations of the estimate that a pair may lie below the threshold and still be verified.
SLACK = 4.5
#: Bytes of text that are sketched at a time, and shingles of sets that a task keeps at hand.
SKETCHED, KEPT_SHINGLES = 1 << 20, 1 << 21
#: Members of a bucket compared in one task, on either side.
TILE = 1024
#: Partners of a minor member of a bucket that are tested before the rest.
LIKELY = 2
#: Ids (of 8 bytes) up to which the texts in doubt are found by a broadcast; beyond, by a shuffle.
BROADCAST_IDS = 1_000_000
#: Edges (of 32 bytes) up to which one task ends a contraction; beyond, rounds over all tasks make them fewer first.
FEW_EDGES = 200_000

_SETS = "doc_id long, text_hash long, n_shingles long, key binary, regs binary"
_PAIR = "a binary, b binary"


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers, one row of M bytes per set (0 for an empty set)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    least = np.full((len(sets), M), np.inf)
    flat = least.reshape(-1)
    e = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    d = np.repeat(np.arange(len(sets)), sizes)
    x = np.zeros(len(e))
    order = mix(e ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    step = ((order >> np.uint64(8)) | np.uint64(1)).astype(np.int64) & (M - 1)
    at = order.astype(np.int64) & (M - 1)
    for j in range(M):
        if not len(e):
            break
        with np.errstate(over="ignore"):
            u = ((mix(e + np.uint64(j + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        x = x - np.log(u) / (RATE * (M - j))
        np.minimum.at(flat, d * M + at, x)
        limit = least.max(1)
        live = x < limit[d]
        e, d, x, step, at = e[live], d[live], x[live], step[live], at[live]
        at = (at + step) & (M - 1)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least) / math.log(BASE))
    k[~np.isfinite(least)] = 0
    return np.clip(k, 0, TOP + 1).astype(np.uint8)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)


_GRID = np.linspace(0, 1, 101)


def estimated(n_a: np.ndarray, n_b: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Jaccard similarity of highest likelihood, given set sizes and how many registers of a lie above (up) and below (down) those of b."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    top = np.minimum(u, v) / np.maximum(u, v)
    out = np.zeros(len(u))
    for at in range(0, len(u), 8192):
        r = slice(at, at + 8192)
        j = top[r, None] * _GRID
        above, below = _p(u[r, None] - v[r, None] * j), _p(v[r, None] - u[r, None] * j)
        same = np.clip(1 - above - below, 1e-12, 1)
        like = up[r, None] * np.log(np.maximum(above, 1e-12)) + down[r, None] * np.log(np.maximum(below, 1e-12)) + (M - up - down)[r, None] * np.log(same)
        out[r] = np.take_along_axis(j, like.argmax(1)[:, None], 1)[:, 0]
    return out


def hopeful(n_a: np.ndarray, n_b: np.ndarray, regs_a: np.ndarray, regs_b: np.ndarray, percent: int) -> np.ndarray:
    """The estimate where a pair may reach the threshold, else -1."""
    fits = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    est = np.full(len(n_a), -1.0)
    t = percent / 100
    least = t - SLACK * math.sqrt(t * (1 - t) / M)
    i = np.flatnonzero(fits)
    i = i[(regs_a[i] == regs_b[i]).sum(1) >= least * M]  # registers are equal with a chance of the similarity or more
    if len(i):
        est[i] = estimated(n_a[i].astype(float), n_b[i].astype(float), (regs_a[i] > regs_b[i]).sum(1), (regs_a[i] < regs_b[i]).sum(1))
    est[est < least] = -1
    return est


def _sketched(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SKETCHED):
            sets = shingle_sets([t or "" for t in batch.column(1).to_pylist()], width)
            regs = registers(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "key", "regs"],
            )

    return run


def sketches(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id, hash of the text, n_shingles, digest of the set and registers."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(_sketched(width), _SETS)


def _regs(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, M)


def _kept_pairs(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            est = hopeful(f["n_a"].to_numpy(), f["n_b"].to_numpy(), _regs(f["regs_a"]), _regs(f["regs_b"]), percent)
            yield f.loc[est >= 0, ["a", "b"]]

    return run


def _codes(column: pa.Array) -> np.ndarray:
    """Digests as pairs of integers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _tiles(columns: tuple[str, ...], compared):
    """Feed whole tiles, which are runs of equal ``columns`` in sorted rows, to ``compared``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([*held, batch])
            same = np.ones(t.num_rows, bool)
            for c in columns:
                last = t.column(c)[-1].as_py()
                same &= np.array([x == last for x in t.column(c).to_pylist()]) if isinstance(last, bytes) else t.column(c).to_numpy() == last
            whole = t.num_rows - int(same.sum())  # the last tile may go on in the next batch
            if whole:
                yield from compared(t.slice(0, whole))
            held = t.slice(whole).combine_chunks().to_batches()
        if held:
            yield from compared(pa.Table.from_batches(held))

    return run


def _hopeful_pairs(t: pa.Table, tile: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (minor row, member row, estimate, components) of the pairs across components that may be links.

    ``tile`` numbers the tiles; in each the minor members (side 1) come first. Where
    the members stand in buckets of a band, a pair counts in the first band alone that
    both share.
    """
    side, n = t.column("side").to_numpy(), t.column("n").to_numpy()
    first = np.flatnonzero(np.diff(tile, prepend=-1))
    minor = np.bincount(tile, side, len(first)).astype(np.int64)
    size = np.diff(np.append(first, len(tile)))
    left = np.flatnonzero(side == 1)
    count, start = (size - minor)[tile[left]], (first + minor)[tile[left]]
    comp = _codes(t.column("comp").combine_chunks())
    regs = np.frombuffer(b"".join(t.column("regs").combine_chunks().to_pylist()), np.uint8).reshape(-1, M)
    band = t.column("band").to_numpy() if "band" in t.column_names else None
    words = regs.view("<u4")  # one per band
    ends, at = np.cumsum(count), 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 50_000, "right")))
        c = count[at:to]
        i = np.repeat(left[at:to], c)
        j = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c) + np.repeat(start[at:to], c)
        apart = (comp[i] != comp[j]).any(1)
        i, j = i[apart], j[apart]
        est = hopeful(n[i], n[j], regs[i], regs[j], percent)
        good = np.flatnonzero(est >= 0)
        if band is not None and len(good):
            same = words[i[good]] == words[j[good]]
            good = good[same.argmax(1) == band[i[good]]]
        if len(good):
            yield i[good], j[good], est[good], comp
        at = to


def _numbered(t: pa.Table, columns: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in columns:
        v = t.column(c).to_pylist()
        new[1:] |= np.array([x != y for x, y in zip(v[1:], v, strict=False)], bool)
    return np.cumsum(new) - 1


def _likely_pairs(percent: int):
    """Per tile and minor member its LIKELY most likely partners; ``cut`` rows name the members of all pairs of those that have more."""
    by = ("bucket", "tile", "part")

    def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, buckets = t.column("key").to_pylist(), t.column("bucket").to_numpy()
        for i, j, est, _ in _hopeful_pairs(t, _numbered(t, by), percent):
            order = np.lexsort((j, -est, i))
            i, j = i[order], j[order]
            start = np.flatnonzero(np.diff(i, prepend=-1))
            size = np.diff(np.append(start, len(i)))
            place = np.arange(len(i)) - np.repeat(start, size)
            cut = np.repeat(size > LIKELY, size)
            kept = np.flatnonzero(place < LIKELY)
            rows = [(min(keys[x], keys[y]), max(keys[x], keys[y]), int(buckets[x]), False) for x, y in zip(i[kept], j[kept], strict=True)]
            rows += sorted({(keys[x], keys[x], int(buckets[x]), True) for x in np.concatenate((i[cut], j[cut])).tolist()})
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.bool_())], names=["a", "b", "bucket", "cut"])

    return _tiles(by, compared)


def _tile_links(width: int, percent: int):
    """Per tile and minor member one verified link to each component that it reaches; all pairs that may be links are tested."""
    by = ("cluster", "tile", "part")

    def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, texts, sets = t.column("key").to_pylist(), t.column("text").to_pylist(), {}

        def of(x: int) -> np.ndarray:
            k = keys[x]
            if k not in sets:
                sets[k] = shingle_sets([texts[x]], width)[0]
            return sets[k]

        done: set[tuple] = set()
        for i, j, est, comp in _hopeful_pairs(t, _numbered(t, by), percent):
            rows = []
            for at in np.lexsort((j, -est, i)):
                x, y = int(i[at]), int(j[at])
                reached = (x, comp[y, 0], comp[y, 1])
                if reached in done:
                    continue
                a, b = of(x), of(y)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    done.add(reached)
                    rows.append((min(keys[x], keys[y]), max(keys[x], keys[y])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["a", "b"])

    return _tiles(by, compared)


def _linked(width: int, percent: int):
    """Pairs whose full sets reach the threshold."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: OrderedDict[bytes, np.ndarray] = OrderedDict()
        held = 0

        def sets_of(keys: pd.Series, texts: pd.Series) -> None:
            nonlocal held
            new = {k: t for k, t in zip(keys, texts, strict=True) if k not in known}
            for k, s in zip(new, shingle_sets(list(new.values()), width), strict=True):
                known[k] = s
                held += len(s)

        for frame in frames:
            for at in range(0, len(frame), 64):
                f = frame.iloc[at : at + 64]
                sets_of(f["a"], f["text_a"])
                sets_of(f["b"], f["text_b"])
                good = []
                for a, b in zip(f["a"], f["b"], strict=True):
                    x, y = known[a], known[b]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * both >= percent * (len(x) + len(y) - both))
                yield f.loc[good, ["a", "b"]]
                while held > KEPT_SHINGLES:
                    held -= len(known.popitem(last=False)[1])

    return run


def _seen(parent: dict, x):
    parent.setdefault(x, x)
    return x


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few edges to (v, to): per vertex the least vertex of its component."""
    parent: dict = {}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(_seen(parent, x)), root(_seen(parent, y))
            if x != y:
                parent[max(x, y)] = min(x, y)
    if parent:
        yield pa.RecordBatch.from_arrays([pa.array(list(parent), kind), pa.array([root(x) for x in parent], kind)], names=["v", "to"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, comp): per vertex of the edges the least vertex of its component.

    While there are many edges, rounds over all tasks contract them: in each round
    every vertex moves to the neighbour, or itself, that comes first in a random order
    of that round; edges follow, and those within one vertex go. So a constant share
    of the vertices leaves per round on any graph, and a star is gone after one or
    two. Every round is written down. The few edges left are united in one task.
    """
    e = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct())
    label: DataFrame | None = None
    turn = 0
    while (left := e.count()) > FEW_EDGES:
        order = lambda c: F.xxhash64(F.col(c), F.lit(turn))  # noqa: B023, E731
        both = e.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(e.select(F.col("b").alias("v"), F.col("a").alias("w")))
        first = both.groupBy("v").agg(F.min(F.struct(order("w").alias("h"), "w")).alias("n"))
        move = written(first.select("v", F.when(order("v") <= F.col("n.h"), F.col("v")).otherwise(F.col("n.w")).alias("to")))
        at = lambda c, to: move.select(F.col("v").alias(c), F.col("to").alias(to))  # noqa: B023, E731
        moved = e.join(at("a", "x"), "a").join(at("b", "y"), "b").where("x != y")
        fewer = written(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        new = move.select("v", F.col("to").alias("comp")) if label is None else label.join(at("comp", "to"), "comp", "left").select("v", F.coalesce("to", "comp").alias("comp"))
        new = written(new)
        removed(e, move, *([] if label is None else [label]))
        e, label, turn = fewer, new, turn + 1
    kind = e.schema["a"].dataType.simpleString()
    last = written(e.repartition(1).mapInArrow(_united, f"v {kind}, to {kind}")) if left else None
    removed(e)
    if label is None:
        return last.withColumnRenamed("to", "comp") if last is not None else written(edges.select(F.col(a).alias("v"), F.col(a).alias("comp")).limit(0))
    if last is not None:
        label = label.join(last.withColumnRenamed("v", "comp"), "comp", "left").select("v", F.coalesce("to", "comp").alias("comp"))
    least = label.groupBy("comp").agg(F.min("v").alias("least"))
    return label.join(least, "comp").select("v", F.col("least").alias("comp"))


def _contracted(comp: DataFrame, links: DataFrame) -> DataFrame:
    """(key, comp) of all keys after the links, given those before."""
    at = lambda side: comp.select(F.col("key").alias(side), F.col("comp").alias(f"c{side}"))
    merged = components(links.join(at("a"), "a").join(at("b"), "b"), "ca", "cb")
    out = written(comp.join(merged.select(F.col("v").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("key", F.coalesce("to", "comp").alias("comp")))
    removed(comp)
    return out


def _texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, text) of the wanted (key, row_id, row_hash); few ids are broadcast, many are shuffled."""
    few = wanted.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(wanted) if few else wanted, docs["row_id"].eqNullSafe(wanted["row_id"]) & (docs["row_hash"] == wanted["row_hash"])).select("key", "text")


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that are links, by the texts of their sets; of repeated rows of an id and a text one is read."""
    ids = written(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct().join(reps, "key").select("key", "row_id", "row_hash"))
    texts = written(_texts_of(ids, docs).dropDuplicates(["key"]))
    full = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    out = written(full.select("a", "b", "text_a", "text_b").mapInPandas(_linked(width, percent), _PAIR))
    removed(ids, texts)
    return out


def _crowded(reps: DataFrame) -> DataFrame:
    """(band, bucket, key) of the members of all buckets that hold more than one key."""
    slices_ = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", i * ROWS + 1, ROWS)) for i in range(BANDS)])
    m = reps.select("key", F.posexplode(slices_).alias("band", "bucket"))
    ends = m.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    return m.join(ends, "bucket").select("band", "bucket", "key")


def _apart(crowded: DataFrame, comp: DataFrame) -> DataFrame:
    """(band, bucket, key, comp, lo, main) of the members of buckets that hold several components; lo is the least key and main its component."""
    m = crowded.join(comp, "key")
    ends = m.groupBy("bucket").agg(F.min(F.struct("key", "comp")).alias("lo"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 != c1")
    return m.join(ends.select("bucket", F.col("lo.key").alias("lo"), F.col("lo.comp").alias("main")), "bucket")


def linked_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = written(sketches(src, width))
    groups = rows.where("n_shingles > 0").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("regs").alias("regs"))
    reps = written(groups.select("key", F.col("rep.doc_id").alias("row_id"), F.col("rep.text_hash").alias("row_hash"), "n", "regs"))
    names = reps.select("key", "row_id", "row_hash")
    texts = src.select(F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_hash"), "text")
    of = lambda side: reps.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("regs").alias(f"regs_{side}"))
    comp = written(reps.select("key", F.col("key").alias("comp")))
    tested: DataFrame | None = None

    def linked_by(pairs: DataFrame) -> None:
        """Test the pairs that no one tested before and contract the links."""
        nonlocal comp, tested
        pairs = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            links = _verified(pairs, names, texts, width, percent)
            comp = _contracted(comp, links)
            removed(links)
        tested = pairs if tested is None else tested.unionByName(pairs)

    members = written(_crowded(reps))
    for bands in GROUPS:
        one = _apart(members.where(F.col("band").isin(*bands)), comp).where("comp != main").groupBy("bucket", "comp").agg(F.min("key").alias("b"), F.min("lo").alias("a"))
        pairs = one.select("a", "b").distinct()
        linked_by(pairs.join(of("a"), "a").join(of("b"), "b").mapInPandas(_kept_pairs(percent), _PAIR))
    crowded = written(_apart(members, comp).select("band", "bucket", "key", "lo"))
    removed(members)
    if not crowded.isEmpty():
        found = written(_tiled(crowded.select("band", "bucket", "key"), "bucket", reps.select("key", "n", "regs"), comp).mapInArrow(_likely_pairs(percent), _PAIR + ", bucket long, cut boolean"))
        linked_by(found.where("NOT cut").select("a", "b").distinct())
        rest = found.where("cut").select(F.col("a").alias("key"), "bucket").distinct()
        if not rest.isEmpty():
            # Joined to clusters, so that a group of near copies is read once and not once per band.
            full = rest.join(crowded.select("bucket", "lo").distinct(), "bucket")
            cluster = components(full.select(F.col("lo").alias("a"), F.col("key").alias("b")))
            cluster = cluster.select(F.col("v").alias("key"), F.col("comp").alias("cluster")).join(rest.select("key").distinct(), "key", "left_semi")
            rich = written(cluster.select("key").join(names, "key"))
            rich = _texts_of(rich, texts).dropDuplicates(["key"])
            rich = written(reps.select("key", "n", "regs").join(rich, "key"))
            late = written(_tiled(cluster, "cluster", rich, comp).mapInArrow(_tile_links(width, percent), _PAIR).distinct())
            if not late.isEmpty():
                comp = _contracted(comp, late)
    joined = names.select("key", "row_id").join(comp, "key")
    least = joined.groupBy("comp").agg(F.min("row_id").alias("least"))
    named = joined.join(least, "comp").select("key", "least")
    whole = rows.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component = F.coalesce("least", "doc_id")
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _tiled(members: DataFrame, group: str, payload: DataFrame, comp: DataFrame) -> DataFrame:
    """Tiles of each group that holds several components: its minor members (side 1), then its members, sorted and side by side."""
    m = members.join(comp, "key")
    per = m.groupBy(group, "comp").agg(F.count(F.lit(1)).alias("c"))
    per = per.groupBy(group).agg(F.max(F.struct("c", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("c").alias("all")).where("comps > 1")
    m = m.join(per.select(group, F.col("main.comp").alias("main"), F.ceil((F.col("all") - F.col("main.c")) / TILE).alias("parts"), F.ceil(F.col("all") / TILE).alias("tiles")), group)
    m = m.join(payload, "key")
    tile, part = F.pmod(F.xxhash64("key"), F.col("tiles")), F.pmod(F.xxhash64("key"), F.col("parts"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    names = [*members.columns, "comp", *[c for c in payload.columns if c != "key"]]
    left = m.where("comp != main").select(*names, each("tiles").alias("tile"), part.alias("part"), F.lit(1).alias("side"))
    right = m.select(*names, tile.alias("tile"), each("parts").alias("part"), F.lit(0).alias("side"))
    by = [group, "tile", "part"]
    return left.unionByName(right).repartition(*by).sortWithinPartitions(*by, F.desc("side"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by shingles of four words as the query's contract has it."""
    return linked_components(table(spark, sf_dir, "documents"), width=4)
