"""License scan by diagonal voting, in DataFrame functions only.

Every position of a text's word sequence forms a rolling k-gram of words. The
k-grams are joined by hash with the k-grams of the templates (a parameter of a few
hundred rows, hence broadcast); the words themselves are compared in the join, so a
hash collision cannot vote. A match at word p of the text and word q of a template
votes for diagonal p - q. Votes are summed by diagonal, neighbouring diagonals
(a few words inserted or dropped) are merged into one span, and a span is verified
by the share of the template's k-grams that it holds and by its length.

Words: A-Z is lower-cased, then maximal runs of digits, a-z and characters above
U+007F. The last rolling position of each text carries an end mark that matches a
template of its own, so the text's word count comes with the votes, each text has
at least one vote and the texts are read once.

Defined results:

* a null text is an empty text: no words, no places, empty labels, score 0;
* repeated rows and repeated ids each give a row of their own; a null doc_id stays
  null; an empty table gives no rows;
* labels are distinct, sorted and joined by commas; overlapping phrases all count;
* other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table

# The base phrases with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Opening words of widespread licences, as their authors publish them.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl-notice"),
    ("this work is licensed under a creative commons attribution", "cc-attribution"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license", "apache-2.0"),
)

K = 3
#: Diagonals so near each other belong to one span.
NEAR = 3
#: Share of a template's k-grams that a span must hold, and its length in template lengths.
COVERAGE, STRETCH = 0.8, 1.5

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ALL = 1 << 30


def words_of(text: Column) -> Column:
    """The words. ``lower`` maps one character above U+007F into a-z, the Kelvin sign, which is put aside first; the rest keep to their side."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(low, SEPARATORS), "")


def template_grams(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """One row per k-gram of each template; phrases under K words are one shorter gram."""
    rows = []
    for kind, phrases in (("base", base), ("notice", notices)):
        for phrase, label in phrases:
            words = phrase.split()
            grams = [words[i : i + K] for i in range(max(1, len(words) - K + 1))]
            name = f"{kind}:{phrase}"
            rows += [(name, kind, label, len(words), len(grams), i, *(g + [None] * K)[:K]) for i, g in enumerate(grams)]
    rows.append(("end", "end", None, 0, 1, 0, "", None, None))
    values = ", ".join("(" + ", ".join("CAST(NULL AS STRING)" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "\\'") + "'" for x in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, kind, label, t_words, t_grams, t_at, t0, t1, t2)")
    return df.withColumn("key", F.when((F.col("t_words") == 1) & F.col("t1").isNull(), F.xxhash64("t0")).otherwise(F.xxhash64("t0", "t1")))


def votes(docs: DataFrame, grams: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match of a text's k-gram with a template's."""
    w = F.array_append(words_of(F.col(text_col)), "").alias("w")
    seq = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), w)
    rolling = seq.select("row", "doc_id", F.posexplode(F.arrays_zip(F.col("w").alias("w0"), F.slice("w", 2, _ALL).alias("w1"), F.slice("w", 3, _ALL).alias("w2"))).alias("at", "g"))
    rolling = rolling.select("row", "doc_id", "at", "g.w0", "g.w1", "g.w2")
    # The end mark is last, so its successors are null as in its template.
    hit = F.col("w0").eqNullSafe(F.col("t0")) & (F.col("t1").isNull() | F.col("w1").eqNullSafe(F.col("t1"))) & (F.col("t2").isNull() | F.col("w2").eqNullSafe(F.col("t2")))
    met = rolling.join(F.broadcast(grams.where("t_words <> 1")), (F.xxhash64("w0", "w1") == F.col("key")) & hit)
    if not grams.where("t_words = 1").isEmpty():  # phrases of one word, which only callers give, are met by that word
        met = met.unionByName(rolling.join(F.broadcast(grams.where("t_words = 1")), (F.xxhash64("w0") == F.col("key")) & hit))
    return met.select("row", "doc_id", "at", "template", "kind", "label", "t_words", "t_grams", "t_at")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, notices=NOTICES) -> DataFrame:
    """One row per text: word count, base places, labels, score and the verified spans."""
    grams = template_grams(docs.sparkSession, base, notices)
    key = ["row", "doc_id", "template", "kind", "label", "t_words", "t_grams"]
    lines = votes(docs, grams, id_col, text_col).groupBy(*key, (F.col("at") - F.col("t_at")).alias("diagonal")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    # A phrase has a place where all its k-grams lie on one diagonal, which is where it begins.
    lines = lines.withColumn("place", F.when(F.col("n") == F.col("t_grams"), F.col("diagonal")))
    order = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > NEAR
    lines = lines.withColumn("new", F.when(apart, 1).otherwise(0)).withColumn("span", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    spans = lines.groupBy(*key, "span").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.count("place").alias("places"), F.min("place").alias("first_place"), F.max("place").alias("last_place"))
    spans = spans.withColumn("coverage", F.least(F.lit(1.0), F.col("n") / F.col("t_grams")))
    fits = (F.col("last") - F.col("first") + K <= STRETCH * F.col("t_words")) & (F.col("coverage") >= COVERAGE)
    spans = spans.where(F.when(F.col("kind") == "notice", fits).otherwise(F.col("places") > 0))
    is_base, is_end = F.col("kind") == "base", F.col("kind") == "end"
    per = spans.groupBy("row", "doc_id").agg(
        F.max(F.when(is_end, F.col("last"))).cast("long").alias("n_words"),
        F.coalesce(F.sum(F.when(is_base, F.col("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(is_base, F.col("first_place"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("last_place"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(~is_end, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(~is_end, F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(~is_end, F.struct("first", "last", "label", "coverage")))).alias("spans"),
    )
    return per.drop("row")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license scan of all documents, without the spans."""
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def _sql_templates() -> str:
    quoted = ", ".join(f"('{kind}:{p}', '{kind}', '{label}', '{p}')" for kind, phrases in (("base", BASE), ("notice", NOTICES)) for p, label in phrases)
    return f"""
  SELECT template, kind, label, len(tw) AS t_words, greatest(1, len(tw) - {K - 1}) AS t_grams, CAST(i - 1 AS INTEGER) AS t_at,
    tw[i] AS t0, tw[i + 1] AS t1, tw[i + 2] AS t2
  FROM (SELECT *, unnest(range(1, greatest(1, len(tw) - {K - 1}) + 1)) AS i
        FROM (SELECT *, string_split(phrase, ' ') AS tw FROM (VALUES {quoted}) AS v(template, kind, label, phrase)))"""


OP3_SQL = rf"""
WITH t AS ({_sql_templates()}
), d AS (
  SELECT row_number() OVER () AS row, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), g AS (
  SELECT row, CAST(i - 1 AS INTEGER) AS p, w[i] AS w0, w[i + 1] AS w1, w[i + 2] AS w2
  FROM (SELECT row, w, unnest(range(1, len(w) + 1)) AS i FROM d)
), v AS (
  SELECT row, template, kind, label, t_words, t_grams, p - t_at AS diagonal, count(*) AS n, min(p) AS first, max(p) AS last
  FROM g JOIN t ON w0 = t0 AND w1 = t1 AND (t2 IS NULL OR w2 = t2) GROUP BY ALL
), s AS (
  SELECT *, sum(new) OVER (PARTITION BY row, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) > {NEAR} THEN 1 ELSE 0 END AS new FROM v)
), m AS (
  SELECT row, template, kind, label, t_words, t_grams, span, sum(n) AS n, min(first) AS first, max(last) AS last,
    least(CAST(1.0 AS DOUBLE), CAST(sum(n) AS DOUBLE) / t_grams) AS coverage
  FROM s GROUP BY row, template, kind, label, t_words, t_grams, span
), k AS (
  SELECT * FROM m WHERE kind = 'base' OR (last - first + {K} <= {STRETCH} * t_words AND coverage >= {COVERAGE})
), a AS (
  SELECT row, CAST(sum(n) FILTER (kind = 'base') AS BIGINT) AS n_base, CAST(min(first) FILTER (kind = 'base') AS BIGINT) AS first_word,
    CAST(max(last) FILTER (kind = 'base') AS BIGINT) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (kind = 'base') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
  FROM k GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, CAST(0.0 AS DOUBLE)) AS score
FROM d LEFT JOIN a USING (row)
"""
