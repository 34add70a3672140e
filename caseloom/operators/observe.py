"""Which observations count, which pages are read again, and which case an observation belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import captured, given, stripped

#: Mean confidence under which a page is read again in another orientation.
LEAST_CONFIDENCE = 35
# The shape of an applicant's name, and the fields that hold one.
NAME_SHAPE, NAME_LENGTHS, NAME_FIELDS = r"^[A-Za-z\-]+ [A-Za-z\-]+$", (10, 18), ("applicant", "registry_name")
# Page furniture that is no field, and the shortest line that can be one.
BOILERPLATE = r"(?i)packet|page\s+\d|synthetic\s+hiring|mib\s+eyes\s+only|scan\s+image|passport\s+image|registry\s+image|form\s+[bi][-\s]?\d+"
LEAST_LINE = 3
# Where a page names its case.
_ID = r"MIB-[A-Z0-9]{6}"
ID_PLACES = {"footer": rf"(?i)\bPacket\s+({_ID})\s*/\s*page\b", "header": rf"(?i)\b({_ID})\s*\|\s*MIB\s+Eyes\s+Only\b", "internal": rf"(?i)\b(?:Case|Cave)\s+(?:ID|1D|10)\s*[:;.-]?\s*({_ID})\b"}


def plausible_name(value: Column) -> Column:
    """Two alphabetic words of ten to eighteen characters together; null is not."""
    v = stripped(value)
    return F.coalesce(v.rlike(NAME_SHAPE) & F.length(v).between(*NAME_LENGTHS), F.lit(False))


def usable(observations: DataFrame) -> DataFrame:
    """Observations of a known case that have a normalized value and are trusted (all are, where no column says so)."""
    trusted = F.coalesce(F.col("trusted"), F.lit(False)) if "trusted" in observations.columns else F.lit(True)
    return observations.where(F.col("case_id").isNotNull() & F.col("normalized_value").isNotNull() & trusted)


def assigned(observations: DataFrame, assignments: DataFrame, on: tuple[str, ...] = ("packet", "page_number")) -> DataFrame:
    """Observations under the case that their page is assigned to; null where it is assigned to none."""
    pages = assignments.select(*on, F.col("case_id").alias("_case"))
    return observations.drop("case_id").join(pages, list(on), "left").withColumnRenamed("_case", "case_id")


def assigned_or_expected(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """(packet, page_number, case_id, method): where no page of a packet names a case, all go to the case that the packet's file names.

    ``pages`` is (packet, page_number, case_id, method), ``expected`` (packet, expected_case_id).
    """
    lost = pages.groupBy("packet").agg(F.count("case_id").alias("n")).where("n = 0").join(expected.where("expected_case_id IS NOT NULL"), "packet").select("packet", "expected_case_id")
    rows = pages.join(lost, "packet", "left")
    taken = F.col("expected_case_id").isNotNull()
    return rows.select("packet", "page_number", F.coalesce("case_id", "expected_case_id").alias("case_id"), F.when(taken, "expected_case_fallback").otherwise(F.col("method")).alias("method"))


def id_candidates(text: Column) -> Column:
    """Struct of the case ids in footer, header and body, their digits repaired; null where none can be read."""
    def one(pattern: str) -> Column:
        digits = F.translate(F.substr(F.upper(captured(text, pattern)), F.lit(5)), "OCIL", "0011")
        return F.when(digits.rlike(r"^\d{6}$"), F.concat(F.lit("MIB-"), digits))

    return F.struct(*[one(p).alias(place) for place, p in ID_PLACES.items()])


def file_case_id(path: Column) -> Column:
    """The case id in a file's name, wherever it stands there."""
    return F.upper(F.nullif(F.regexp_extract(F.regexp_extract(path, r"([^/]*)$", 1), r"(?i)(MIB-\d{6})", 1), F.lit("")))


def field_count(fields: Column) -> Column:
    """How many fields of a map have a value."""
    return F.size(F.map_filter(fields, lambda k, v: given(v).isNotNull()))


def read_again(document_type: Column, fields: Column, confidence: Column) -> Column:
    """Whether a page should be tried in other orientations: of unknown type, without a field, or read with little confidence."""
    return (document_type == "unknown") | (F.coalesce(field_count(fields), F.lit(0)) == 0) | F.coalesce(confidence < LEAST_CONFIDENCE, F.lit(False))


def missing(field: Column, value: Column) -> Column:
    """Whether a field needs another reading: empty, or a name that is none."""
    empty = F.coalesce(value, F.lit("")) == ""
    return empty | (field.isin(*NAME_FIELDS) & ~(value.rlike(NAME_SHAPE) & F.length(value).between(*NAME_LENGTHS)))


def orphans(lines: Column, values: Column) -> Column:
    """Lines that hold none of the extracted values and are no page furniture."""
    known = F.filter(values, lambda v: F.coalesce(v, F.lit("")) != "")
    return F.filter(lines, lambda line: (F.length(line) >= LEAST_LINE) & ~line.rlike(BOILERPLATE) & ~F.exists(known, lambda v: F.contains(F.lower(line), F.lower(v))))


def filled(fields: Column, recovered: Column, wanted: list[str]) -> Column:
    """The map of fields, with recovered values for the wanted ones that are missing and for no others."""
    entries = [F.struct(F.lit(f).alias("key"), F.try_element_at(recovered, F.lit(f)).alias("value"), missing(F.lit(f), F.try_element_at(fields, F.lit(f))).alias("open")) for f in wanted]
    use = F.filter(F.array(*entries), lambda e: e["open"] & (F.coalesce(e["value"], F.lit("")) != ""))
    taken = F.transform(use, lambda e: e["key"])
    new = F.map_from_arrays(taken, F.transform(use, lambda e: e["value"]))
    return F.map_concat(F.map_filter(fields, lambda k, v: ~F.array_contains(taken, k)), new)
