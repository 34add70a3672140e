"""Page operators: classification, extraction, corrections, suspicious and visible text, routes, orphan lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import captured, collapsed, first_captured

_ARRIVAL = r"(?:Arrival|Antval|Amival|Arnval|Ariival|Arival)"
_ID = r"Case\s+(?:ID|1D|10)\s*[:;.-]?\s*"


def _until(stops: str, sep: str = r"\s+") -> str:
    """Free text up to the next label of the page, or its end."""
    return rf"(.+?)(?={sep}(?:{stops})\b|\z)"


# The labels that end a value on each form.
_INTAKE = rf"Case\s+(?:ID|1D|10)|Applicant|Species\s+Code|Home\s+World|Visa\s+(?:Class|Close)|Sponsor\s+(?:ID|1D|10)|{_ARRIVAL}\s+Date|Declared\s+Purpose|PASSPORT\s+IMAGE|Manual\s+correction\s*:|SAMPLE\s+(?:DENIAL|APPROVAL)|Packet"
_REGISTRY = rf"Applicant|Registry\s+Name|Home\s+World|Species\s+Code|Registry\s+Status|{_ARRIVAL}\s+Date|REGISTRY\s+IMAGE|Packet"
_SPONSOR = r"Case\s+ID|Sponsor\s+ID|Applicant|Purpose|Visa\s+Class|Packet\s+MIB-\d+\s*/\s*page|Synthetic\s+hiring"
_SLIP = r"Case\s+(?:ID|1D|10)|Applicant|Species\s+Match|Biometric\s+confidence|Observed\s+flags|SCAN\s+IMAGE|PacketSynthetic\s+hiring"
_SLIP_SEP = r"[\s|‘’'\"`()\[\]{}:;,.=—–-]+"
# The labels and value shapes of each document type; several patterns are tried in order.
PATTERNS = {
    "intake_form": {
        "case_id": (rf"(?i){_ID}(M[I1]B-\d+)",), "applicant": (rf"(?is)Applicant\s*[:;.-]?\s*{_until(_INTAKE)}",), "species_code": (r"(?i)Species\s+Code\s*[:;.-]?\s*([A-Z][A-Z0-9_]+)",),
        "home_world": (rf"(?is)Home\s+World\s*[:;.-]?\s*{_until(_INTAKE)}",), "visa_class": (r"(?i)Visa\s+(?:Class|Close)\s*[:;.-]?\s*([A-Z0-9]+(?:[-.][A-Z0-9]+)?)",),
        "sponsor_id": (r"(?i)Sponsor\s+(?:ID|1D|10)\s*[:;.=]?\s*(SPN[- ]?\d+)",), "arrival_date": (rf"(?i){_ARRIVAL}\s+Date\s*[:;.-]?\s*(\d{{4}}[-.]\d{{2}}[-.]\d{{2}})",),
        "declared_purpose": (r"(?is)Declared\s+Purpose\s*[:;.-]?\s*" + _until(r"Manual\s+correction\s*:|SAMPLE\s+(?:DENIAL|APPROVAL)|Packet\s+MIB-\d+\s*/\s*page"),),
    },
    "biometric_slip": {
        "case_id": (rf"(?i){_ID}([A-Z0-9-]+)",), "applicant": (rf"(?is)Applicant\s*[:;.-]?\s*{_until(_SLIP, _SLIP_SEP)}",), "species_match": (rf"(?is)Species\s+Match\s*[:;.-]?\s*{_until(_SLIP, _SLIP_SEP)}",),
        "biometric_confidence": (r"(?i)Biometric\s+confidence\s*[:;.-]?\s*(\d{1,3}\s*%)",), "observed_flags": (r"(?i)Observed\s+flags\s*[:;.-]?\s*([a-z0-9_|]+)",),
    },
    "sponsor_attestation": {
        "case_id": (r"(?i)\b(MIB-\d+)\b",), "sponsor_id": (r"(?i)Sponsor\s+ID\s*:?\s*(SPN[- ]?\d(?:[\d ]*\d)?)", r"(?i)Sponsor\s+(SPN[- ]?\d(?:[\d ]*\d)?)\s+attests\b"),
        "applicant": (rf"(?i)Applicant\s*:?\s*{_until(_SPONSOR)}", r"(?i)attests\s+that\s+(.+?)\s+is\s+expected\b"), "purpose": (rf"(?is)Purpose\s*:?\s*{_until(_SPONSOR)}", r"(?is)is\s+expected\s+on\s+Earth\s+for\s+(.+?)\."),
        "visa_class": (r"(?i)Visa\s+Class\s*:?\s*([A-Z0-9-]+)", r"(?i)responsibility\s+for\s+class\s+([A-Z0-9-]+)\s+compliance"),
    },
    "registry_extract": {
        "applicant": (rf"(?is)(?:Applicant|Registry\s+Name)\s*[:;.-]?\s*{_until(_REGISTRY)}",), "home_world": (rf"(?is)Home\s+World\s*[:;.-]?\s*{_until(_REGISTRY)}",), "species_code": (r"(?i)Species\s+Code\s*[:;.-]?\s*([A-Z][A-Z0-9_]+)",),
        "registry_status": (rf"(?is)Registry\s+Status\s*[:;.-]?\s*{_until(_REGISTRY)}",), "arrival_date": (rf"(?i){_ARRIVAL}\s+Date\s*[:;.-]?\s*(\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}})",),
    },
    "fee_receipt": {
        "case_id": (rf"(?i){_ID}(MIB-\d+)",), "fee_status": (r"(?i)Fee\s+Status\s*[:;.-]?\s*([A-Za-z_]+)",), "amount": (r"(?i)Amount\s*[:;.-]?\s*\$?\s*([\d,]+(?:\.\d{2})?)",), "waiver_code": (r"(?i)Waiver\s+Code\s*[:;.-]?\s*([A-Z0-9/_-]+)",),
    },
    "adjudicator_note": {
        "case_id": (r"(?i)\b(MIB-\d+)\b",), "decision": (r"(?im)Finding\s*:\s*(APPROVED|DENIED|NEEDS_REVIEW)\b", r"(?im)^\s*(APPROVED|DENIED|REVIEW)\s*$"), "reason": (r"(?is)Reason\s*:\s*(.+?)(?=\s+Packet\s+MIB-\d+\s*/\s*page\b|\z)",),
    },
}
#: For a page of unknown type the extractors are tried in this order.
FALLBACK = ("fee_receipt", "intake_form", "registry_extract", "biometric_slip", "sponsor_attestation", "adjudicator_note")


def field_map(text: Column, kind: str) -> Column:
    """A page's fields by the patterns of its type, nulls left out."""
    return _present({f: first_captured(text, *p) for f, p in PATTERNS[kind].items()})


def unknown_field_map(text: Column) -> Column:
    fields: dict[str, list[Column]] = {}
    for kind in FALLBACK:
        for f, p in PATTERNS[kind].items():
            fields.setdefault(f, []).append(first_captured(text, *p))
    return _present({f: F.coalesce(*c) for f, c in fields.items()})


def _present(fields: dict[str, Column]) -> Column:
    entries = F.create_map(*[x for f, c in fields.items() for x in (F.lit(f), c)])
    return F.map_filter(entries, lambda k, v: v.isNotNull())


def extracted(kind: Column, text: Column) -> Column:
    """The field map by document type."""
    out = None
    for k in PATTERNS:
        out = F.when(kind == k, field_map(text, k)) if out is None else out.when(kind == k, field_map(text, k))
    return out.otherwise(unknown_field_map(text))


def cue_text(text: Column) -> Column:
    v = F.lower(text)
    for wrong, right in vocab.OCR_FIXES:
        v = F.replace(v, F.lit(wrong), F.lit(right))
    return collapsed(F.regexp_replace(F.regexp_replace(v, r"[_|:;/\\\-]+", " "), r"[^a-z0-9\s]", " "))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def classified(text: Column) -> Column:
    """(document_type, score, confidence) by the cues that the text contains."""

    def cued(at: int, kind: str, least: int, field: Column):
        return lambda h: F.struct((-(h + field)).alias("score"), F.lit(at).alias("at"), F.lit(kind).alias("kind"), F.lit(least).alias("least"), (h > 0).alias("headed"))

    def ranked(t: Column) -> Column:
        scores = []
        for at, (kind, (least, headings, fields)) in enumerate(vocab.DOCUMENT_CUES.items()):
            heading = F.greatest(*[F.when(t.contains(h), w).otherwise(0) for h, w in headings.items()])
            field = sum((F.when(t.contains(f), w).otherwise(0) for f, w in fields.items()), F.lit(0))
            scores.append(_let(heading, cued(at, kind, least, field)))
        return F.array_sort(F.array(*scores))

    def judged(r: Column) -> Column:
        best, second = F.get(r, 0), F.get(r, 1)
        score, margin = -best["score"], second["score"] - best["score"]
        raw = 0.35 + 0.035 * score + 0.04 * margin
        raw = F.when(best["headed"], raw).otherwise(F.least(raw, F.lit(0.90)))
        known = score >= best["least"]
        return F.struct(F.when(known, best["kind"]).otherwise("unknown").alias("document_type"), score.alias("score"), F.when(known, F.round(F.least(raw, F.lit(1.0)), 3)).otherwise(0.0).alias("confidence"))

    return _let(_let(cue_text(text), ranked), judged)


def suspicious(text: Column, patterns=vocab.SUSPICIOUS) -> Column:
    """The patterns that a text matches."""
    t = F.lower(collapsed(text))
    return F.array_compact(F.array(*[F.when(t.rlike(p), F.lit(p)) for p in patterns]))


def near_white(color: Column, least: float = 0.92) -> Column:
    channel = lambda shift: F.shiftright(color, shift).bitwiseAND(255) / 255.0
    return (channel(16) >= least) & (channel(8) >= least) & (channel(0) >= least)


def on_page(b: Column, width: Column, height: Column, share: float = 0.5) -> Column:
    """Whether at least this share of a box lies on the page; a box without area never does."""
    area = (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])
    seen = F.greatest(F.lit(0.0), F.least(b["x1"], width) - F.greatest(b["x0"], F.lit(0.0))) * F.greatest(F.lit(0.0), F.least(b["y1"], height) - F.greatest(b["y0"], F.lit(0.0)))
    return F.coalesce((area > 0) & (F.try_divide(seen, area) >= share), F.lit(False))


def visible_text(spans: Column, width: Column, height: Column) -> Column:
    seen = F.filter(spans, lambda s: (F.trim(s["text"]) != "") & ~near_white(s["color"]) & on_page(s["bbox"], width, height))
    return F.array_join(F.transform(seen, lambda s: s["text"]), " ")


def hidden_text(spans: Column, width: Column, height: Column) -> Column:
    kept = F.filter(spans, lambda s: (F.trim(s["text"]) != "") & (near_white(s["color"]) | ~on_page(s["bbox"], width, height)))
    return F.array_join(F.transform(kept, lambda s: s["text"]), " ")


# The routes of a page, in the order in which they are tried. Columns: name, method, strategy, whether the
# native text is used, the page rendered and read, the native text ignored, orientation found, the page turned and deskewed,
# contrast enhanced, noise removed, a threshold applied. Where a cell names a measurement, that decides.
ROUTE_COLUMNS = ("extraction_method", "ocr_strategy", "use_native_text", "render_page", "run_ocr", "ignore_native_text", "detect_orientation", "rotate", "deskew", "enhance_contrast", "denoise", "threshold")
ROUTES = {
    "usable": ("native_text", "none", True, False, False, False, False, False, False, False, False, False),
    "suspicious": ("standard_ocr", "suspicious_text_layer", False, True, True, True, True, True, True, "low_contrast", "low_sharpness", "low_contrast"),
    "scan_readable": ("standard_ocr", "standard", False, True, True, True, True, True, True, False, False, False),
    "scan_degraded": ("degraded_scan_ocr", "degraded_scan", False, True, True, True, True, True, True, "low_contrast", True, True),
    "mixed_content": ("standard_ocr", "standard", False, True, True, True, True, True, True, "low_contrast", False, False),
    "otherwise": ("ocr_fallback", "fallback", False, True, True, True, True, True, True, True, True, True),
}
REASONS = {
    "usable": "The native PDF text layer is sufficiently populated and trusted.",
    "suspicious": "The native text layer contains suspicious instruction-like content. The visible page must be rendered and OCR must be performed without using or merging the native text.",
    "scan_readable": "The page is image-based but has adequate visual quality for standard OCR.",
    "scan_degraded": "The page is image-based and visually degraded. OCR should use preprocessing and may require multiple attempts.",
    "mixed_content": "The page contains mixed visual and textual content, but its native text was not accepted. OCR the rendered page.",
    "otherwise": "The page does not provide enough trusted native text and does not match a more specific route. Use the OCR fallback pipeline.",
}


def route(usable: Column, suspicious_layer: Column, quality_class: Column, low_contrast: Column | None = None, low_sharpness: Column | None = None) -> Column:
    """The struct of ``ROUTE_COLUMNS`` and reason of the first route that applies."""
    known = {"low_contrast": low_contrast if low_contrast is not None else F.lit(False), "low_sharpness": low_sharpness if low_sharpness is not None else F.lit(False)}
    cell = lambda v: known.get(v, F.lit(v)) if isinstance(v, str) else F.lit(v)
    made = {name: F.struct(*[cell(v).alias(c) for c, v in zip(ROUTE_COLUMNS, row, strict=True)], F.lit(REASONS[name]).alias("reason")) for name, row in ROUTES.items()}
    out = F.when(usable, made["usable"]).when(suspicious_layer, made["suspicious"])
    for name in ("scan_readable", "scan_degraded", "mixed_content"):
        out = out.when(quality_class == name, made[name])
    return out.otherwise(made["otherwise"])


# How a correction note begins, and its free text.
_CORRECTION = r"(?i)Manual\s+correction\s*:\s*([^\n|]{0,90})"
# What a correction note calls a field, and the shape of its value.
_PHRASES = (("fee status", "fee_status"), ("visa class", "visa_class"), ("species code", "species_code"), ("home world", "home_world"), ("arrival date", "arrival_date"), ("declared purpose", "declared_purpose"), ("applicant", "applicant"), ("sponsor", "sponsor_id"), ("species", "species_code"))
_VALUES = {"fee_status": r"(?i)\b(paid|waived|unpaid|unknown)\b", "visa_class": r"(?i)\b(XW-1|XW-2|DIP-1|MED-3|TRANSIT-7)\b", "sponsor_id": r"(?i)\b(SPN-\d{4})\b", "arrival_date": r"\b(\d{4}-\d{2}-\d{2})\b", "species_code": r"(?i)\b([A-Z][A-Z0-9_]{3,})\b"}
_FREE = r"(?i)\bis\s+(.+?)\s*(?:[.;|]|$)"


def corrections(text: Column) -> Column:
    """Field to value of a page's correction notes; of several notes for a field the last counts."""
    notes = F.regexp_extract_all(text, F.lit(_CORRECTION), F.lit(1))

    def entry(body: Column) -> Column:
        out = None
        for phrase, field in _PHRASES:
            value = captured(body, _VALUES[field]) if field in _VALUES else captured(body, _FREE)
            value = F.lower(value) if field == "fee_status" else F.upper(value) if field in ("visa_class", "sponsor_id", "species_code") else value
            made = F.struct(F.lit(field).alias("key"), value.alias("value"))
            test = F.lower(body).contains(phrase)
            out = F.when(test, made) if out is None else out.when(test, made)
        return out

    found = F.filter(F.transform(notes, entry), lambda e: e.isNotNull() & e["value"].isNotNull())
    return F.aggregate(found, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))


def without_corrections(text: Column) -> Column:
    return F.regexp_replace(text, _CORRECTION, " ")


def missing_marker(field: Column, text: Column) -> Column:
    """The placeholder for the field that a page shows, if any."""
    out = None
    for name, marks in vocab.MISSING_MARKERS.items():
        hit = F.coalesce(*[F.when(F.upper(text).contains(m), F.lit(m)) for m in marks])
        out = F.when(field == name, hit) if out is None else out.when(field == name, hit)
    return out


def candidate_score(text: Column, ocr_confidence: Column, known: Column, class_score: Column, class_confidence: Column, fields: Column) -> Column:
    """Score of one way to read a page; the highest is kept."""
    return 25.0 * known.cast("int") + class_score + 10.0 * class_confidence + 6.0 * fields + 0.02 * F.coalesce(ocr_confidence, F.lit(0.0)) + 0.005 * F.least(F.length(F.trim(text)), F.lit(500))
