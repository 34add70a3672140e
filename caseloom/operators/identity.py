"""Which case a page belongs to: structural ids, established ids, links by metadata."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import vocab
from ..functions.similarity import alike_among


def structural_id(footer: Column, header: Column, internal: Column) -> Column:
    """(case_id, method, mismatch) by precedence footer, header, internal."""
    seen = F.array_distinct(F.array_compact(F.array(footer, header, internal)))
    method = F.when(footer.isNotNull(), "footer").when(header.isNotNull(), "header").when(internal.isNotNull(), "internal").otherwise("none")
    return F.struct(F.coalesce(footer, header, internal).alias("case_id"), method.alias("method"), (F.size(seen) > 1).alias("mismatch"))


def established(pages: DataFrame, packet: str = "packet", case: str = "case_id") -> DataFrame:
    """Ids seen on more than one page of a packet."""
    return pages.where(F.col(case).isNotNull()).groupBy(packet, case).agg(F.count(F.lit(1)).alias("pages")).where("pages > 1")


def pages_per_case(pages: DataFrame, packet: str = "packet", case: str = "case_id", page: str = "page_number") -> DataFrame:
    return pages.groupBy(packet, case).agg(F.array_join(F.array_sort(F.collect_set(page)).cast("array<string>"), ",").alias("pages"), F.count(F.lit(1)).alias("n"))


def value_sets(rows: DataFrame, keys: list[str], field: str = "field", value: str = "value") -> DataFrame:
    """The distinct non-blank values of each field, sorted."""
    v = F.nullif(F.trim(F.col(value)), F.lit(""))
    return rows.groupBy(*keys, field).agg(F.array_sort(F.collect_set(v)).alias("values")).where(F.size("values") > 0)


#: Pairs of a page and a case that are scored at once.
PAIRS = 1_000_000


def _pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions in both of every pair of equal numbers."""
    order = np.argsort(right, kind="stable")
    ordered = right[order]
    first, last = np.searchsorted(ordered, left, "left"), np.searchsorted(ordered, left, "right")
    n = last - first
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.arange(len(left)), n), order[np.repeat(first, n) + at]


def _linked(of: np.ndarray, owners: np.ndarray, fields: np.ndarray, value: np.ndarray, names: list[str], texts: pa.Array, n_cases: int, n_pages: int):
    """Per tile of pages (first page, best case or -1, its score, the next score, and (field name, same, conflicting) of the best).

    A row says that page or case (``of``: 0 or 1) ``owners`` has in field ``fields`` a value, -1 if null; cases are numbered by rank.
    """
    rows = {f: ((fields == f) & (of == 0), (fields == f) & (of == 1)) for f in range(len(names))}
    rows = {f: r for f, r in rows.items() if r[0].any() and r[1].any()}
    step = max(1, PAIRS // max(1, n_cases))
    for start in range(0, n_pages, step):
        n = min(step, n_pages - start)
        score, valid, told = np.zeros((n, n_cases), np.int64), np.zeros((n, n_cases), bool), []
        for f, (in_pages, in_cases) in rows.items():
            mine = in_pages & (owners >= start) & (owners < start + n)
            page, case = owners[mine] - start, owners[in_cases]
            met = np.zeros((n, n_cases), bool)
            met[np.ix_(np.unique(page), np.unique(case))] = True
            v, w = value[mine], value[in_cases]
            page, v, case, w = page[v >= 0], v[v >= 0], case[w >= 0], w[w >= 0]
            same = np.zeros((n, n_cases), bool)
            i, j = _pairs(v, w)
            same[page[i], case[j]] = True
            if names[f] == "applicant_name" and len(w):
                known, at = np.unique(w, return_inverse=True)
                written = texts.take(known).to_pylist()
                for one in np.unique(v):
                    like = np.array(alike_among(written, texts[one].as_py()), bool)
                    same[np.ix_(np.unique(page[v == one]), np.unique(case[like[at]]))] = True
            valid |= met
            score += np.where(same, vocab.LINK_WEIGHTS.get(names[f], 0), -vocab.LINK_PENALTIES.get(names[f], 0)) * met
            told.append((names[f], met, same))
        least, at = np.iinfo(np.int64).min, np.arange(n)
        score[~valid] = least
        best = score.argmax(1) if n_cases else np.zeros(n, np.int64)
        top = score[at, best]
        score[at, best] = least
        after = score.max(1)
        yield start, np.where(top == least, -1, best), top, np.where(after == least, 0, after), [(name, same[at, best], (met & ~same)[at, best]) for name, met, same in told]


def link_scores(page_values: DataFrame, case_values: DataFrame) -> DataFrame:
    """Best case per page: score, margin to the next, matched and conflicting fields.

    Both inputs are (packet, page_number | case_id, field, value). They meet on packet
    and field, never across packets. Names agree if they read alike (``alike``); all
    else agrees exactly. The values of a packet come to one task, which scores its pages
    against its cases tile by tile, so that no pair is ever written down.
    """
    kind = lambda df, c: df.schema[c].dataType
    page_type, case_type = kind(page_values, "page_number"), kind(case_values, "case_id")
    side = lambda df, page, case: df.where(F.col("packet").isNotNull() & F.col("field").isNotNull()).select("packet", page.cast(page_type).alias("page_number"), case.cast(case_type).alias("case_id"), "field", "value")
    pages = side(page_values, F.col("page_number"), F.lit(None)).withColumn("of", F.lit(0))
    cases = side(case_values, F.lit(None), F.col("case_id")).withColumn("of", F.lit(1))
    schema = StructType([StructField("packet", kind(page_values, "packet")), StructField("page_number", page_type), StructField("case_id", case_type), *[StructField(c, LongType()) for c in ("score", "matched")], StructField("conflicts", StringType()), StructField("second", LongType())])
    arrow = to_arrow_schema(schema)

    def numbered(owners: pa.ChunkedArray) -> tuple[np.ndarray, list]:
        """Ranks of the owners, null first, and the owners by rank."""
        known = owners.unique()
        known = known.take(pc.sort_indices(known, null_placement="at_start"))
        return pc.index_in(owners, value_set=known).to_numpy().astype(np.int64), known

    def best(packet: pa.Table) -> pa.Table:
        of = packet["of"].to_numpy()
        on_page = pa.array(of == 0)
        page_at, page_ids = numbered(packet.filter(on_page)["page_number"])
        case_at, case_ids = numbered(packet.filter(pc.invert(on_page))["case_id"])
        if not len(page_ids) or not len(case_ids):
            return arrow.empty_table()
        owners = np.empty(len(of), np.int64)
        owners[of == 0], owners[of == 1] = page_at, case_at
        field = packet["field"].combine_chunks().dictionary_encode()
        value = packet["value"].combine_chunks().dictionary_encode()
        numbers = value.indices.fill_null(-1).to_numpy().astype(np.int64)
        parts = []
        for start, at, score, second, told in _linked(of, owners, field.indices.to_numpy(), numbers, field.dictionary.to_pylist(), value.dictionary, len(case_ids), len(page_ids)):
            kept = np.flatnonzero(at >= 0)
            told = sorted(told, key=lambda x: x[0])
            matched = sum((same for _, same, _ in told), np.zeros(len(at), np.int64))
            conflicts = [",".join(name for name, _, clash in told if clash[i]) for i in kept]
            parts.append(pa.table([packet["packet"].combine_chunks()[:1].take(np.zeros(len(kept), np.int64)), page_ids.take(start + kept), case_ids.take(at[kept]), score[kept], matched[kept], pa.array(conflicts, pa.string()), second[kept]], schema=arrow))
        return pa.concat_tables(parts)

    found = pages.unionByName(cases).groupBy("packet").applyInArrow(best, schema)
    clash = F.arrays_overlap(F.split("conflicts", ","), F.array(F.lit("applicant_name"), F.lit("sponsor_id")))
    return found.withColumn("safe", (F.col("matched") >= 2) & (F.col("score") >= 7) & (F.col("score") - F.col("second") >= 3) & ~clash)


#: Characters that a block of alike ids may leave out of either; beyond, ids of two lengths meet pair by pair.
MOST_LEFT_OUT = 3


def _shortened(x: Column, n: int) -> Column:
    """The distinct strings that are left when n characters are taken out."""
    out = F.array(x)
    for _ in range(n):
        out = F.array_distinct(F.flatten(F.transform(out, lambda s: F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1))))))
    return out


def near_established(pages: DataFrame, packet: str = "packet", case: str = "case_id", least: float = 0.85) -> DataFrame:
    """(packet, case_id, assigned): ids seen once that read like an established id of the packet; the nearest, then the least.

    Matching blocks are a common subsequence, so ids that are alike share what is left
    of each without a few characters. Ids of a packet meet on that, by a join of equal
    strings, and are then compared; ids so long that too many characters may differ
    meet pair by pair.
    """
    from ..functions.similarity import ratio_udf

    per = pages.where(F.col(case).isNotNull()).groupBy(packet, case).agg(F.count(F.lit(1)).alias("pages"))
    lone = per.where("pages = 1").select(packet, F.col(case).alias("case_id"))
    known = per.where("pages > 1").select(packet, F.col(case).alias("assigned"))
    sizes = sorted(r["n"] for r in per.select(F.length(case).alias("n")).distinct().collect())  # one row per length of an id
    shared, apart = {}, []
    for a in sizes:
        for b in sizes:
            block = math.ceil(least * (a + b) / 2 - 1e-9)
            if block <= min(a, b):
                if max(a, b) - block <= MOST_LEFT_OUT and min(a, b) > 0:
                    shared[a, b] = block
                else:
                    apart.append((a, b))

    def blocks(df: DataFrame, column: str, side: int) -> DataFrame:
        tagged = lambda tag: lambda s: F.struct(F.lit(tag).alias("tag"), s.alias("left"))
        parts = [F.when(F.length(column) == pair[side], F.transform(_shortened(F.col(column), pair[side] - block), tagged(f"{pair[0]}/{pair[1]}"))) for pair, block in shared.items()]
        none = F.array().cast("array<struct<tag:string,left:string>>")
        return df.withColumn("_b", F.explode(F.flatten(F.array(*[F.coalesce(p, none) for p in parts])))).select(packet, column, "_b.tag", "_b.left")

    met = lone.join(known, packet).where(F.lit(False))
    if shared:
        met = blocks(lone, "case_id", 0).join(blocks(known, "assigned", 1), [packet, "tag", "left"]).select(packet, "case_id", "assigned").distinct()
    if apart:
        pairs = F.array(*[F.struct(F.lit(a), F.lit(b)) for a, b in apart])
        met = met.unionByName(lone.join(known, packet).where(F.array_contains(pairs, F.struct(F.length("case_id"), F.length("assigned")))))
    met = met.withColumn("ratio", ratio_udf("case_id", "assigned")).where(F.col("ratio") >= least)
    w = W.partitionBy(packet, "case_id").orderBy(F.desc("ratio"), "assigned")
    return met.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(packet, "case_id", "assigned")
