"""Sources: packets, labels, submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREDICTION_COLUMNS = ("case_id", "applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "risk_flags", "fee_status", "adjudication")
PREDICTION = T.StructType([*[T.StructField(c, T.StringType()) for c in PREDICTION_COLUMNS], T.StructField("confidence", T.DoubleType())])


def packets(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """One row per PDF of a folder (not of those below it): case_id from the name, path, length, content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(path)
    columns = [F.regexp_extract("path", r"([^/]+)\.[pP][dD][fF]$", 1).alias("case_id"), "path", "length"]
    return files.select(*columns, *(["content"] if content else []))


def file_sizes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row: number and bytes of the files under a folder whose names match; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def text_layers(files: DataFrame, reader) -> DataFrame:
    """(case_id, page_number, width, height, text, words, blocks, spans) of the pages of files (case_id, content).

    ``reader`` is not part of this library: a function of a file's bytes that gives, per
    page, a dict of width, height, text, words, blocks and spans (text, color, bbox of
    x0, y0, x1, y1).
    """
    import pandas as pd

    span = "struct<text:string,color:int,bbox:struct<x0:double,y0:double,x1:double,y1:double>>"
    names = ["width", "height", "text", "words", "blocks", "spans"]

    def run(frames):
        for frame in frames:
            for case, content in zip(frame["case_id"], frame["content"], strict=True):
                found = list(reader(content)) if content is not None else []
                if found:
                    yield pd.DataFrame([{"case_id": case, "page_number": n, **{k: page.get(k) for k in names}} for n, page in enumerate(found, 1)], columns=["case_id", "page_number", *names])

    return files.select("case_id", "content").mapInPandas(run, f"case_id string, page_number int, width double, height double, text string, words array<string>, blocks int, spans array<{span}>")


def csv_rows(spark: SparkSession, path: str, columns: list[str] | None = None, multiline: bool = True) -> DataFrame:
    """A CSV with header, every column a string; a byte order mark is dropped. With ``columns`` the header must be exactly these.

    A file whose values hold line breaks is one task; without ``multiline`` files are split.
    """
    found = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').csv(path)
    found = found.toDF(*[c.lstrip("﻿") for c in found.columns])
    if columns is not None and found.columns != list(columns):
        raise ValueError(f"the header is {found.columns}, not {list(columns)}")
    return found


def manifest_ids(spark: SparkSession, path: str, column: str = "case_id") -> DataFrame:
    """The case ids that a manifest lists, trimmed, with the blank ones left out."""
    return csv_rows(spark, path).select(F.trim(column).alias("case_id")).where("case_id <> ''")


def jsonl_rows(spark: SparkSession, path: str, schema: T.StructType = PREDICTION) -> DataFrame:
    """JSON lines; blank lines are skipped, a malformed one fails the read and is quoted with its file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")).where(F.trim("value") != "")
    read = F.from_json("value", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.withColumn("r", read)
    message = F.concat(F.lit("malformed line in "), F.col("_file"), F.lit(": "), F.substring("value", 1, 200))
    checked = F.when(F.col("r._bad").isNull(), F.col("r")).otherwise(F.raise_error(message).cast(read_type(schema)))
    return rows.select(checked.alias("r")).select(*[f"r.{f.name}" for f in schema.fields])


def read_type(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])


def bad_lines(spark: SparkSession, path: str, schema: T.StructType = PREDICTION) -> DataFrame:
    """(file, line, value) of the malformed lines of JSON line files, counted from 1. Files are read whole to number their lines."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("n", "value"))
    rows = files.where(F.trim("value") != "").withColumn("r", F.from_json("value", read_type(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return rows.where("r._bad IS NOT NULL").select("file", (F.col("n") + 1).alias("line"), "value")


def located(ids: DataFrame, files: DataFrame) -> DataFrame:
    """(case_id, path): the file named exactly like the case, else the first whose name begins with its id.

    ``files`` is (stem, path). Names meet ids by the id's own length, so nothing is compared pair by pair.
    """
    exact = files.groupBy("stem").agg(F.min("path").alias("exact"))
    sizes = ids.select(F.length("case_id").alias("size")).distinct()
    begun = files.join(F.broadcast(sizes), F.length("stem") >= F.col("size")).groupBy(F.expr("substring(stem, 1, size)").alias("begin")).agg(F.min("path").alias("near"))
    out = ids.join(exact, ids["case_id"] == exact["stem"], "left").join(begun, ids["case_id"] == begun["begin"], "left")
    return out.select("case_id", F.coalesce("exact", "near").alias("path"))


def json_rows(spark: SparkSession, path: str, schema: T.StructType = PREDICTION) -> DataFrame:
    """One JSON document of any accepted shape: list; object with a list under a known name; one row; map by case_id."""
    whole = spark.read.text(path, wholetext=True)
    rows = T.ArrayType(schema)
    named = [F.from_json(F.get_json_object("value", f"$.{n}"), rows) for n in ("predictions", "submission", "results", "cases")]
    single = F.when(F.get_json_object("value", "$.case_id").isNotNull(), F.array(F.from_json("value", schema)))
    listed = F.when(F.ltrim("value").startswith("["), F.from_json("value", rows))
    keyed = F.transform(F.map_entries(F.from_json("value", T.MapType(T.StringType(), schema))), lambda e: e["value"].withField("case_id", F.coalesce(e["value"]["case_id"], e["key"])))
    return whole.select(F.explode(F.coalesce(listed, *named, single, keyed)).alias("r")).select("r.*")


def submission(spark: SparkSession, path: str) -> DataFrame:
    """By suffix, or by the first character of the file."""
    if path.endswith(".csv"):
        return csv_rows(spark, path, [*PREDICTION_COLUMNS, "confidence"])
    if path.endswith(".jsonl"):
        return jsonl_rows(spark, path)
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    line = first[0][0].strip() if first else ""
    if line.startswith("{") and line.endswith("}") and not path.endswith(".json"):
        return jsonl_rows(spark, path)
    return json_rows(spark, path)
