"""Fields behind damaged labels.

Runs of one and two words of a page are fragments. Each distinct fragment of a batch
of pages is compared once with the labels of its page's type. A label's value stands
between it and the next label; values of a closed vocabulary are matched once per
distinct window. Pages stay rows throughout, so nothing is shuffled or sent about.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import vocab
from ..functions.similarity import best_many, compare_text, ratio
from ..functions.stored import checkpointed
from ..functions.text import given, literal_map, stripped
from .pages import PATTERNS

#: Least similarity of a label and its lead over the next; characters of a value at most; words of a term.
LABEL_SCORE, LABEL_MARGIN, VALUE_CHARS, VALUE_WORDS = 0.78, 0.10, 80, 2
# Labels of each document type and the fields they name.
DOCUMENT_LABELS = {
    "intake_form": {"Case ID": "case_id", "Applicant": "applicant", "Species Code": "species_code", "Home World": "home_world", "Visa Class": "visa_class", "Sponsor ID": "sponsor_id", "Arrival Date": "arrival_date", "Declared Purpose": "declared_purpose", "Purpose": "declared_purpose", "World": "home_world"},
    "fee_receipt": {"Case ID": "case_id", "Fee Status": "fee_status", "Amount": "amount", "Waiver Code": "waiver_code"},
    "registry_extract": {"Registry Name": "applicant", "Home World": "home_world", "Species Code": "species_code", "Registry Status": "registry_status", "Arrival Date": "arrival_date"},
    "biometric_slip": {"Case ID": "case_id", "Applicant": "applicant", "Species Match": "species_match", "Biometric confidence": "biometric_confidence", "Observed flags": "observed_flags"},
    "sponsor_attestation": {"Case ID": "case_id", "Sponsor ID": "sponsor_id", "Applicant": "applicant", "Purpose": "purpose", "Visa Class": "visa_class"},
    "adjudicator_note": {"Finding": "decision", "Reason": "reason"},
}
# The shape of a field's value, or its vocabulary.
SHAPES = {"case_id": r"(?i)\bM[I1l]B[-\s]?[0-9OoIl]{6}\b", "sponsor_id": r"(?i)\bSPN[-\s]?[0-9OoIl]{4}\b", "arrival_date": r"\b\d{4}[-/.]\d{1,2}[-/.]\d{1,2}\b", "amount": r"\$?\s*[\d,]+\.\d{2}\b", "biometric_confidence": r"\b\d{1,3}\s*%"}
VOCABULARIES = {"species_code": vocab.SPECIES, "species_match": vocab.SPECIES, "home_world": vocab.HOME_WORLDS, "visa_class": vocab.VISA_CLASSES, "declared_purpose": vocab.PURPOSES, "purpose": vocab.PURPOSES, "fee_status": vocab.FEE_STATUSES, "observed_flags": vocab.RISK_FLAGS, "decision": (*vocab.DECISIONS, "REVIEW")}
#: A page of unknown type could be any form; of labels that several types have the last type counts.
ANY_LABELS = {label: field for labels in DOCUMENT_LABELS.values() for label, field in labels.items()}


def _labels_of(kind: Column) -> Column:
    """Label to field by the page's type."""
    out = None
    for name, labels in DOCUMENT_LABELS.items():
        out = F.when(kind == name, literal_map(labels)) if out is None else out.when(kind == name, literal_map(labels))
    return out.otherwise(literal_map(ANY_LABELS))


def _declared(kind: Column, found: Column) -> Column:
    """The fields that the patterns of a type look for; those of an unknown page are the ones they found."""
    out = None
    for name, fields in PATTERNS.items():
        made = F.array(*[F.lit(f) for f in fields])
        out = F.when(kind == name, made) if out is None else out.when(kind == name, made)
    return out.otherwise(F.map_keys(found))


def wanted(kind: Column, found: Column) -> Column:
    """Fields to look for behind damaged labels: the missing ones, and those with a vocabulary; an empty list stands for all."""
    declared = _declared(kind, found)
    return F.array_union(F.array_except(declared, F.map_keys(found)), F.array_intersect(declared, F.array(*[F.lit(f) for f in VOCABULARIES])))


def _fragments(text: str) -> list[tuple[int, int, str]]:
    """(start, end, fragment): runs of one and two words with their places in the text, counted from 0; at a start the longer first."""
    words = [m.span() for m in re.finditer(r"[A-Za-z][A-Za-z0-9]*", text)]
    out = []
    for i, (start, end) in enumerate(words):
        if i + 1 < len(words):
            out.append((start, words[i + 1][1], text[start : words[i + 1][1]]))
        out.append((start, end, text[start:end]))
    return out


def _labels(fragments: set[str], terms: tuple[str, ...]) -> dict[str, str]:
    """Fragment to the label that it reads like, of those that read like one."""
    known = list(fragments)
    return {f: label for f, label in zip(known, best_many(known, terms, LABEL_SCORE, LABEL_MARGIN, compare_text), strict=True) if label}


def _hits(fragments: list[tuple[int, int, str]], labels: dict[str, str]) -> list[tuple[int, int, str]]:
    """(start, end, label): the labels of a page in order, the longest at a place, none that begins inside the one before."""
    kept: list[tuple[int, int, str]] = []
    for start, end, fragment in fragments:
        if fragment in labels and (not kept or start >= kept[-1][1]):
            kept.append((start, end, labels[fragment]))
    return kept


def _terms(windows: list[str], vocabulary: tuple[str, ...]) -> list[str | None]:
    """Per window the term that a run of its words reads most like; the first of equals. Each distinct run is matched once."""
    pieces = []
    for window in windows:
        words = re.findall(r"[A-Za-z0-9][A-Za-z0-9_/-]*", window)
        pieces.append([" ".join(words[i : i + n]) for i in range(len(words)) for n in range(1, min(VALUE_WORDS, len(words) - i) + 1)])
    known = list({p for run in pieces for p in run})
    matches = best_many(known, vocabulary, 0.72, 0.08, compare_text)
    scored = {p: (ratio(compare_text(p), compare_text(m)), m) for p, m in zip(known, matches, strict=True) if m}
    found = [[scored[p] for p in run if p in scored] for run in pieces]
    return [max(f, key=lambda x: x[0])[1] if f else None for f in found]


@F.pandas_udf(ArrayType(StructType([StructField("field", StringType()), StructField("window", StringType()), StructField("term", StringType())])))
def _behind_labels(texts: pd.Series, labels: pd.Series) -> pd.Series:
    """What stands behind the labels of each page, in order: its field, its text, and the term that it reads like.

    Labels are written (label, field, label, field, ...). Each distinct fragment and window of a batch is compared once.
    """
    written, chosen = texts.tolist(), [tuple(x) for x in labels]
    pieces = [_fragments(text) for text in written]
    distinct: dict[tuple, set[str]] = {}
    for of, found in zip(chosen, pieces, strict=True):
        distinct.setdefault(of, set()).update(f for _, _, f in found)
    read = {of: _labels(found, of[::2]) for of, found in distinct.items()}
    pages, windows = [], {}
    for text, of, found in zip(written, chosen, pieces, strict=True):
        hits, fields, page = _hits(found, read[of]), dict(zip(of[::2], of[1::2], strict=True)), []
        for i, (_, end, label) in enumerate(hits):
            stop = min(hits[i + 1][0] if i + 1 < len(hits) else len(text), end + VALUE_CHARS)
            page.append((fields[label], text[end:stop]))
            windows.setdefault(fields[label], {})[text[end:stop]] = None
        pages.append(page)
    for field in windows.keys() & VOCABULARIES.keys():
        windows[field] = dict(zip(windows[field], _terms(list(windows[field]), VOCABULARIES[field]), strict=True))
    return pd.Series([[{"field": f, "window": w, "term": windows[f][w]} for f, w in page] for page in pages], dtype="object")


def _free(window: Column) -> Column:
    """Text after a label's own mark, up to a gap or a bracket."""
    body = stripped(F.regexp_replace(window, r"^\s*[:;.,=-]+\s*", ""))
    return given(F.regexp_replace(body, r"(?s)(?:\s{3,}|[|\\(\[]|[—_]{2,}).*$", ""))


def behind_labels(text: Column, kind: Column, wanted: Column) -> Column:
    """Field to value by labels; the first label of a field that has a value counts. An empty ``wanted`` stands for all fields."""
    labels = _labels_of(kind)
    chosen = F.when(F.size(wanted) > 0, F.map_filter(labels, lambda k, v: F.array_contains(wanted, v))).otherwise(labels)
    flat = F.flatten(F.transform(F.map_entries(chosen), lambda e: F.array(e["key"], e["value"])))

    def entry(h: Column) -> Column:
        field, window, value = h["field"], h["window"], None
        for name, shape in SHAPES.items():
            found = given(F.regexp_extract(window, shape, 0))
            value = F.when(field == name, found) if value is None else value.when(field == name, found)
        return F.struct(field.alias("key"), value.when(field.isin(*VOCABULARIES), h["term"]).otherwise(_free(window)).alias("value"))

    found = F.filter(F.transform(_behind_labels(F.coalesce(text, F.lit("")), flat), entry), lambda e: e["value"].isNotNull())
    first = lambda m, e: F.when(F.map_contains_key(m, e["key"]), m).otherwise(F.map_concat(m, F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))
    return F.aggregate(found, F.create_map().cast("map<string,string>"), first)


def fields_by_labels(pages: DataFrame) -> DataFrame:
    """(_page, loose) of the pages (_page, text, kind, wanted) that have such fields."""
    p = pages.select("_page", behind_labels(F.col("text"), F.col("kind"), F.col("wanted")).alias("loose"))
    return p.where(F.size("loose") > 0)


def completed(pages: DataFrame, kind: str = "document_type", text: str = "text", found: str = "found") -> DataFrame:
    """The pages with their map of fields completed by what stands behind damaged labels.

    Missing fields are filled; a field with a vocabulary takes an exact term in place
    of what the patterns found. One term never takes the place of a list of flags.
    """
    # Written down, or the optimizer would search each page once for every use of its fields.
    p = checkpointed(pages.withColumn("loose", behind_labels(F.col(text), F.col(kind), wanted(F.col(kind), F.col(found)))))
    terms = F.create_map(*[x for f, v in VOCABULARIES.items() for x in (F.lit(f), F.array(*[F.lit(t) for t in v]))])
    have = F.col(found)

    def taken(field: Column, value: Column) -> Column:
        exact = F.coalesce(F.array_contains(F.try_element_at(terms, field), value), F.lit(False))
        listed = (field == "observed_flags") & F.contains(F.try_element_at(have, field), F.lit("|"))
        return ~F.map_contains_key(have, field) | (exact & ~F.coalesce(listed, F.lit(False)))

    p = p.withColumn("_new", F.map_filter("loose", taken))
    return p.withColumn(found, F.map_concat(F.map_filter(have, lambda k, v: ~F.map_contains_key(F.col("_new"), k)), F.col("_new"))).drop("loose", "_new")
