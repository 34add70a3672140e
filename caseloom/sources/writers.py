"""Sinks: JSON lines, JSON, CSV, the constant baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import PREDICTION_COLUMNS


def write_jsonl(df: DataFrame, path: str, order: str = "case_id", single: bool = False) -> None:
    """Sorted JSON lines with nulls written; in one file only if asked for."""
    rows = df.orderBy(order)
    lines = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    (lines.coalesce(1) if single else lines).write.mode("overwrite").text(path)


def sorted_json(df: DataFrame, pretty: bool = False) -> DataFrame:
    """(value): one JSON object per row, keys in order, nulls written."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false", "pretty": str(pretty).lower()}).alias("value"))


def write_json(df: DataFrame, path: str, pretty: bool = True) -> None:
    """JSON objects with their keys in order."""
    sorted_json(df, pretty).write.mode("overwrite").text(path)


def write_diagnostics(df: DataFrame, path: str, keys: list[str]) -> None:
    """One JSON object per group of keys, its rows listed under ``results``."""
    rest = [c for c in sorted(df.columns) if c not in keys]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list(F.struct(*rest))).alias("results"))
    write_json(grouped, path, pretty=False)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def baseline(ids: DataFrame, confidence: float = 0.5) -> DataFrame:
    """The same cautious prediction for every case."""
    fixed = {"sponsor_id": "SPN-0000", "arrival_date": "1970-01-01", "risk_flags": "none", "fee_status": "unknown", "adjudication": "NEEDS_REVIEW"}
    return ids.select("case_id", *[F.lit(fixed.get(c, "")).alias(c) for c in PREDICTION_COLUMNS if c != "case_id"], F.lit(confidence).alias("confidence"))
