"""Field normalizers: one per field, null for what cannot be read.

The Columns settle what exact rules settle. ``normalized`` adds the best match in the
field's vocabulary for the values that these leave, once per distinct value.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import vocab
from .similarity import best, compare_text, ratio, unaccented
from .stored import checkpointed
from .text import collapsed, given, literal_map, strict_date, stripped


def _compact(x: Column) -> Column:
    return F.regexp_replace(F.upper(x), r"(?U)\s+", "")


def case_id(x: Column) -> Column:
    """Prefix and digits repaired, not validated."""
    v = F.regexp_replace(_compact(F.nullif(x, F.lit(""))), "^MIB[-_]?", "MIB-")
    return F.concat(F.lit("MIB-"), F.translate(F.substr(v, F.lit(5)), "OCIL", "0011"))


def case_id_candidate(x: Column) -> Column:
    v = case_id(x)
    return F.when(v.rlike(r"^MIB-\d+$"), v)


def sponsor_id(x: Column) -> Column:
    v = F.regexp_replace(_compact(F.nullif(x, F.lit(""))), "^SPN[-_]?", "SPN-")
    return F.concat(F.lit("SPN-"), F.translate(F.substr(v, F.lit(5)), "OIL", "011"))


def _visa(x: Column) -> Column:
    v = _compact(x)
    return F.coalesce(F.try_element_at(literal_map(vocab.VISA_ALIASES), v), v)


def visa_class(x: Column) -> Column:
    """Aliases and exact members; ``normalized`` has the best match of the rest."""
    v = _visa(x)
    return F.when(v.isin(*vocab.VISA_CLASSES), v)


def fee_status(x: Column) -> Column:
    return F.translate(stripped(F.lower(F.nullif(x, F.lit("")))), "10", "io")


def _species(x: Column) -> Column:
    v = F.regexp_replace(F.regexp_replace(F.upper(stripped(x)), r"(?U)[\s-]+", "_"), "_+", "_")
    return F.regexp_replace(v, "^_+|_+$", "")


def species_code(x: Column) -> Column:
    """Exact members; ``normalized`` has the best match of the rest."""
    v = _species(x)
    return F.when(v.isin(*vocab.SPECIES), v)


def home_world(x: Column) -> Column:
    """Exact members; ``normalized`` has the rest, also without accents or case."""
    v = collapsed(x)
    return F.when(v.isin(*vocab.HOME_WORLDS), v)


def declared_purpose(x: Column) -> Column:
    """Exact members in any case; ``normalized`` has the best match of the rest."""
    v = collapsed(F.lower(x))
    return F.when(v.isin(*vocab.PURPOSES), v)


def date(x: Column) -> Column:
    """ISO from dashes, slashes or dots, also with single digits; otherwise the input."""
    v = F.nullif(x, F.lit(""))
    part = lambda i: F.regexp_extract(v, r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})$", i)
    iso = F.concat_ws("-", part(1), F.lpad(part(3), 2, "0"), F.lpad(part(4), 2, "0"))
    return F.coalesce(F.date_format(strict_date(iso), "yyyy-MM-dd"), v)


def risk_flag(x: Column) -> Column:
    v = F.regexp_replace(F.regexp_replace(F.lower(stripped(x)), r"(?U)[\s-]+", "_"), "_+", "_")
    return F.regexp_replace(v, "^_+|_+$", "")


def _flags(x: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(x, r"[|,;]+"), risk_flag), lambda f: f != "")))


def risk_flags(x: Column) -> Column:
    """Known flags of a list, distinct and sorted; ``none`` only if alone; ``normalized`` matches the unknown ones as well."""
    flags = F.filter(_flags(x), lambda f: f.isin(*vocab.RISK_FLAGS))
    real = F.array_remove(flags, "none")
    return F.when(F.size(flags) > 0, F.array_join(F.when(F.size(real) > 0, real).otherwise(flags), "|"))


def waiver_code(x: Column) -> Column:
    v = F.upper(stripped(x))
    return F.when(v.isin("NA", "N-A", "NOT APPLICABLE"), "N/A").otherwise(v)


def amount(x: Column) -> Column:
    return F.replace(F.nullif(F.regexp_extract(x, r"([\d,]+(?:\.\d{1,2})?)", 1), F.lit("")), F.lit(","), F.lit("")).try_cast("double")


#: Normalizer by field; other fields keep their raw value.
BY_FIELD = {"case_id": case_id, "sponsor_id": sponsor_id, "visa_class": visa_class, "fee_status": fee_status, "species_code": species_code, "home_world": home_world, "declared_purpose": declared_purpose, "arrival_date": date, "risk_flags": risk_flags}


def by_field(field: Column, raw: Column) -> Column:
    """The value by the exact rules of the field's name."""
    out = None
    for name, f in BY_FIELD.items():
        out = F.when(field == name, f(raw)) if out is None else out.when(field == name, f(raw))
    return out.otherwise(given(raw))


#: Vocabulary, least score and margin of a best match by field.
MATCHES = {"visa_class": (vocab.VISA_CLASSES, 0.75, 0.10), "species_code": (vocab.SPECIES, 0.72, 0.08), "home_world": (vocab.HOME_WORLDS, 0.72, 0.08), "declared_purpose": (vocab.PURPOSES, 0.72, 0.08)}
FLAG_SCORE, FLAG_MARGIN, MARKER_SCORE = 0.65, 0.08, 0.65
_MARKERS = tuple(m.strip("[]") for m in vocab.MISSING_MARKERS["applicant"])
#: Matches of at most this many values are sent to all workers.
FEW = 100_000


def matched(field: str, value: str) -> str | None:
    """What a value that the exact rules leave stands for; of a name, the marker of a lost name that it is."""
    if field == "applicant_name":
        return next((m for m in _MARKERS if ratio(value[: len(m)], m) >= MARKER_SCORE), None)
    if field == "risk_flags":
        flags = {f if f in vocab.RISK_FLAGS else best(f, vocab.RISK_FLAGS, FLAG_SCORE, FLAG_MARGIN) for f in value.split("|")} - {None}
        return "|".join(sorted(flags - {"none"} or flags)) or None
    if field == "home_world":
        value = unaccented(value)
        same = {compare_text(c): c for c in vocab.HOME_WORLDS}.get(compare_text(value))
        if same:
            return same
    return best(value, *MATCHES[field], compare_text)


@F.pandas_udf(StringType())
def _matched(fields: pd.Series, values: pd.Series) -> pd.Series:
    return pd.Series([matched(f, v) for f, v in zip(fields, values, strict=True)], dtype="object")


def _open(field: Column, raw: Column) -> Column:
    """What is left to match of a value: its form for comparison, null if the exact rules settle it."""
    known = {"visa_class": _visa, "species_code": _species, "home_world": collapsed, "declared_purpose": lambda x: collapsed(F.lower(x))}
    left = F.when((field == "applicant_name") & given(raw).isNotNull(), F.substring(F.upper(stripped(raw)), 1, max(map(len, _MARKERS))))
    left = left.when((field == "risk_flags") & F.exists(_flags(raw), lambda f: ~f.isin(*vocab.RISK_FLAGS)), F.array_join(_flags(raw), "|"))
    for name, f in known.items():
        left = left.when((field == name) & ~f(raw).isin(*MATCHES[name][0]), f(raw))
    return left


def normalized(df: DataFrame, field: str = "field", raw: str = "raw_value", out: str = "normalized_value") -> DataFrame:
    """The frame with its normalized values, by the exact rules or else by the best match.

    The rules that ask for a match run on distinct readings, and the matching on the
    distinct forms that these leave. Values that nothing matches are not in the table
    of matches, so the join finds no row for them. Where the distinct readings are few,
    the exact rules run on them alone as well, and all rows look their value up.
    """
    # Written down, or the optimizer would move the rules back to all rows.
    readings = checkpointed(df.select(F.col(field).alias("_field"), F.col(raw).alias("_raw")).distinct())
    seen = readings.withColumn("_left", _open(F.col("_field"), F.col("_raw"))).where("_left IS NOT NULL")
    found = seen.select("_field", "_left").distinct().withColumn("_match", _matched("_field", "_left")).where("_match IS NOT NULL")
    near = checkpointed(seen.join(found, ["_field", "_left"]).select("_field", "_raw", "_match"))
    few = near.count() <= FEW
    of = F.col("_field"), F.col("_raw")
    if few and readings.count() <= FEW:
        value = F.when((of[0] == "applicant_name") & F.col("_match").isNotNull(), None).otherwise(F.coalesce("_match", by_field(*of)))
        found = checkpointed(readings.join(near.hint("broadcast"), ["_field", "_raw"], "left").select("_field", "_raw", value.alias(out)))
        return df.join(found.hint("broadcast"), df[field].eqNullSafe(found["_field"]) & (df[raw] == found["_raw"]), "left").select(*df.columns, out)
    joined = df.join(near.hint("broadcast") if few else near, (df[field] == near["_field"]) & (df[raw] == near["_raw"]), "left")
    value = F.when((F.col(field) == "applicant_name") & F.col("_match").isNotNull(), None).otherwise(F.coalesce("_match", by_field(F.col(field), F.col(raw))))
    return joined.withColumn(out, value).select(*df.columns, out)
