"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A text's shingles are its runs of five words (words as in the license scan). The
sketch is the k least of their distinct 64-bit hashes, ascending. Sketches of parts
merge into the sketch of the whole; two sketches estimate resemblance and
containment, one estimates the number of distinct shingles.

Each document also meets the next one by doc_id. Ids are cut into ranges of even
counts; the first document of each range is sent to the range before it as well,
so that one exchange of the texts serves and no range needs another. An id (or no
id) that has more rows than a range should is cut by a hash of the text as well, and
its equal rows, whose next one is their like, go as one row with their number.

Defined results:

* a null text is an empty text, whose sketch is empty; a text of fewer than five
  words has one shingle, all its words; two empty sketches are alike (1), an empty
  and a non-empty one are not (0);
* rows of equal id follow each other in order of a hash of their texts, then of the
  texts; a null id comes first; the only row of a table is its own next one; repeated rows are kept;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table
from .license import words_of

SHINGLE, K = 5, 128
#: Ranges of ids, at most; their first ids are what is broadcast.
RANGES = 4096
#: Rows of one id up to which it is never cut.
HOT_ROWS = 10_000


def sketch(words: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The bottom-k sketch of an array of words."""
    at = F.sequence(F.lit(0), F.size(words) - size)
    many = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))
    hashes = F.when(F.size(words) >= size, many).when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    both = merged(a, b, k)
    return F.when(F.size(both) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), both)) / F.size(both))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    j = resemblance(a, b, k)
    union = distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), j * union / distinct_count(a, k)))


def fingerprint(a: Column) -> Column:
    """A sketch as a string of hex digits, 16 per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _spans(given: Column, key: Column, cut: Column, bounds: list[tuple[int, int, int]]) -> Column:
    """How many bounds (given, id, cut) are at or below a row's, by binary search in literal arrays."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    high = (1, 2**63 - 1, 2**63 - 1)
    g, i, c = (F.lit([b[k] for b in [*bounds, *[high] * (2**steps - len(bounds))]]) for k in range(3))
    sizes = F.lit([2 ** (steps - 1 - s) for s in range(steps)])

    def below(at: Column) -> Column:
        same_id = (F.get(i, at) < key) | (F.get(i, at) == key) & (F.get(c, at) <= cut)
        return (F.get(g, at) < given) | (F.get(g, at) == given) & same_id

    return F.aggregate(sizes, F.lit(0), lambda at, step: F.when(below(at + step - 1), at + step).otherwise(at))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(span, given, id, cut, text, copies, extra): all documents and, per range, the one that follows it (extra = 1, ordered last).

    ``cut`` is a hash of the text; ``copies`` counts the equal rows that a row stands for.
    """
    given, key = F.col(id_col).isNotNull().cast("int"), F.coalesce(F.col(id_col).cast("long"), F.lit(0))
    src = docs.select(given.alias("given"), key.alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("cut", F.xxhash64("text"))
    spark = docs.sparkSession
    n = min(RANGES, 8 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = src.agg(F.percentile_approx(F.when(F.col("given") == 1, F.col("id")), [i / n for i in range(1, n)] or [0.5], 20 * n).alias("c"), F.count(F.lit(1)).alias("n")).first()
    bounds = {(1, c, -(2**63)) for c in found["c"] or []}
    per = src.groupBy("given", "id").agg(F.count(F.lit(1)).alias("n"))
    total = found["n"]
    hot = [(r["given"], r["id"], r["n"]) for r in per.where(F.col("n") > max(HOT_ROWS, 2 * total // n)).collect()]  # n ids at most
    for g, i, count in hot:
        parts = -(-count * n // total)
        bounds |= {(g, i, -(2**63) + p * (2**64 // parts)) for p in range(parts)}
    if hot:
        ids = F.broadcast(spark.createDataFrame([(g, i) for g, i, _ in hot], "given int, id long"))
        like = src.join(ids, ["given", "id"]).groupBy("given", "id", "cut", "text").agg(F.count(F.lit(1)).alias("n"))
        # Of equal rows all but the last are followed by their like: one row for those, one for the last.
        like = like.select("given", "id", "text", "cut", F.explode(F.when(F.col("n") > 1, F.array(F.col("n") - 1, F.lit(1).cast("long"))).otherwise(F.array(F.lit(1).cast("long")))).alias("copies"))
        src = src.join(ids, ["given", "id"], "left_anti").select("given", "id", "text", "cut", F.lit(1).cast("long").alias("copies")).unionByName(like)
    else:
        src = src.withColumn("copies", F.lit(1).cast("long"))
    src = src.withColumn("span", _spans(F.col("given"), F.col("id"), F.col("cut"), sorted(bounds)))
    # A row per range: 3 n rows at most.
    firsts = src.groupBy("span").agg(F.min(F.struct("given", "id", "cut")).alias("first"))
    last = F.max("span").over(W.partitionBy())
    firsts = firsts.select(F.col("span").alias("of"), "first", F.coalesce(F.lag("span").over(W.orderBy("span")), last).alias("to"))
    lead = src.join(F.broadcast(firsts), (F.col("span") == F.col("of")) & (F.struct("given", "id", "cut") == F.col("first")))
    lead = lead.groupBy("to").agg(F.min(F.struct("given", "id", "cut", "text")).alias("d"))
    columns = ("given", "id", "cut", "text", "copies")
    extra = lead.select(F.col("to").alias("span"), "d.*", F.lit(1).cast("long").alias("copies"), F.lit(1).alias("extra"))
    return src.select("span", *columns, F.lit(0).alias("extra")).unionByName(extra)


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: sizes, edited text's digest, both fingerprints and both likenesses."""
    along = W.partitionBy("span").orderBy("extra", "given", "id", "cut", "text")
    rows = with_next(docs, id_col, text_col).withColumn("next_text", F.lead("text").over(along))
    n = F.length("text")
    take = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - take), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), take))
    order = ("span", "extra", "given", "id", "cut", "text")
    rows = rows.select(*order, "copies", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("edited_words", words_of(F.col("edited")))
    rows = rows.withColumn("s", sketch(F.col("words"))).withColumn("es", F.when(F.col("extra") == 0, sketch(F.col("edited_words"))))
    rows = rows.drop("words", "edited_words").withColumn("ns", F.lead("s").over(along)).where("extra = 0")
    return rows.select(
        F.when(F.col("given") == 1, F.col("id")).alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("s")).alias("fingerprint"), fingerprint(F.col("es")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("es")).alias("near_edited"), resemblance(F.col("s"), F.col("ns")).alias("near_next"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_"),
    ).drop("_")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return fingerprinted(table(spark, sf_dir, "documents"))
