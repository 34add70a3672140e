"""Fixed values of the case domain: vocabularies, tiers, weights, patterns."""

from __future__ import annotations

# Closed vocabularies.
SPECIES = ("TRIANGULAN", "JOVIAN_GASFORM", "CENTAURI_SYNTH", "LUNA_SECURID", "KAIJU_MICRO", "ORION_GRAYS", "ALPHA_DRACONIAN", "SIRIUS_AVIAN", "VENUSIAN_MYCELIAL", "AQUARIAN_MANTIS", "ARCTURIAN", "ANDROMEDAN")
PURPOSES = ("reactor maintenance", "field repair", "medical consult", "research", "cultural exchange", "translation", "archive audit", "xenobotany", "diplomatic", "transit")
HOME_WORLDS = ("Luyten-b", "Europa Station", "Titan Freeport", "Barnard-c", "Gliese-581g", "Mars Dome-7", "Kepler-186f", "Sirius Outpost", "Wolf-1061c", "Proxima-b", "Zeta Reticuli", "TRAPPIST-1e", "Eris Relay")
VISA_CLASSES = ("MED-3", "DIP-1", "XW-1", "XW-2", "TRANSIT-7")
VISA_ALIASES = {"XW1": "XW-1", "XW2": "XW-2", "MED3": "MED-3", "DIP1": "DIP-1", "TRANSIT7": "TRANSIT-7"}
FEE_STATUSES = ("paid", "waived", "unpaid", "unknown")
DECISIONS = ("APPROVED", "DENIED", "NEEDS_REVIEW")
DISQUALIFYING = ("memory_tampering", "planetary_embargo", "active_warrant", "biohazard_red")
REVIEW_ONLY = ("identity_conflict", "sponsor_mismatch", "illegible_biometrics", "rescinded_denial")
RISK_FLAGS = (*DISQUALIFYING, *REVIEW_ONLY, "none")
REVOKED_LISTED = ("SPN-0007", "SPN-0139", "SPN-4040")
REVOKED_INFERRED = ("SPN-9090", "SPN-2718", "SPN-7331")
# Trust tiers, lower is better for documents, higher for sources.
DOCUMENT_TIERS = {"adjudicator_note": 1, "intake_form": 2, "fee_receipt": 2, "biometric_slip": 3, "sponsor_attestation": 4, "registry_extract": 5, "unknown": 6}
DEFAULT_TIER = 6
SOURCE_TIERS = {"native_text": 3, "ocr": 2}
# Policy.
RECEIVED, STALE_DAYS = "2026-07-12", 180
# Page fields that are written under another name.
ALIASES = {"applicant": "applicant_name", "registry_name": "applicant_name", "species_match": "species_code", "species": "species_code", "purpose": "declared_purpose", "observed_flags": "risk_flags", "decision": "adjudicator_decision", "reason": "adjudicator_reason"}
# Scoring.
FIELD_WEIGHTS = {"applicant_name": 5, "species_code": 6, "home_world": 5, "visa_class": 5, "sponsor_id": 5, "arrival_date": 4, "declared_purpose": 3, "risk_flags": 8, "fee_status": 4}
EXTRACTION_POINTS, CLASS_POINTS, CALIBRATION_POINTS, MISSING_CAP, CLASS_RAW = 50, 80, 20, 10, 8
# Linking pages to cases.
LINK_WEIGHTS = {"sponsor_id": 6, "applicant_name": 5, "species_code": 3, "arrival_date": 3, "home_world": 2, "visa_class": 2, "declared_purpose": 1}
LINK_PENALTIES = {**LINK_WEIGHTS, "sponsor_id": 7}
# Text that looks like instructions.
SUSPICIOUS = (r"\bsystem\s*:", r"\bignore\s+(the\s+)?visible\s+evidence\b", r"\bignore\s+(all\s+)?previous\s+instructions\b", r"\boutput\s+(this\s+)?answer\s+key\b", r"\bfake\s+answer\s+key\b", r"\bhidden\s+text\b", r"\bprompt\s+injection\b")
# Bonuses of the review queue.
CATEGORY_BONUS = {"pipeline_error": 10.0, "field_not_extracted": 5.0, "missing_value": 4.0, "normalization_returned_none": 3.5, "corroboration_conflict": 3.0, "incorrect_value": 2.0, "unexpected_prediction": 1.0}
# Placeholders for values that a page shows as lost.
MISSING_MARKERS = {"arrival_date": ("UNREADABLE", "[DATE WASHED OUT]"), "sponsor_id": ("[SPONSOR ID BLANK]",), "species_code": ("[SPECIES WHITEOUT]",), "home_world": ("[REGISTRY LOST]",), "visa_class": ("[VISA CLASS TORN]",), "declared_purpose": ("[PURPOSE ILLEGIBLE]",), "applicant": ("[NAME CUT OUT]",), "observed_flags": ("[RISK PANEL MISSING]",), "fee_status": ("[FEE STATUS OBSCURED]",)}
# Cues of document types: least score, headings and fields with weights.
DOCUMENT_CUES = {
    "intake_form": (5, {"form i 8090": 8, "extraterrestrial work authorization intake": 8, "mib intake form": 8, "temporary work authorization application": 8, "applicant intake": 6}, {"case id": 1, "applicant": 1, "species code": 2, "home world": 2, "visa class": 1, "sponsor id": 1, "arrival date": 2, "declared purpose": 3}),
    "biometric_slip": (5, {"form b 13": 8, "biometric scan slip": 8, "biometric verification": 8, "biometric slip": 7}, {"biometric confidence": 4, "species match": 3, "observed flags": 3, "biometric status": 3, "identity match": 3, "biohazard check": 3, "scan image": 1}),
    "sponsor_attestation": (6, {"sponsor attestation letter": 10, "sponsor attestation": 9, "sponsor declaration": 8}, {"sponsor id": 4, "applicant": 1, "purpose": 2, "visa class": 2, "sponsor signature": 3, "applicant sponsored": 3, "cultural exchange": 2}),
    "registry_extract": (5, {"planetary registry extract": 10, "registry extract": 8, "mib registry record": 8}, {"registry name": 3, "registry status": 4, "home world": 1, "species code": 1, "arrival date": 1, "warrant status": 3, "embargo status": 3}),
    "fee_receipt": (5, {"mib fee receipt": 10, "payment receipt": 8, "fee receipt": 8}, {"fee status": 4, "amount": 2, "amount paid": 3, "waiver code": 3, "payment reference": 3}),
    "adjudicator_note": (5, {"adjudicator note": 9, "manual review note": 8, "decision note": 7}, {"adjudicator": 4, "decision": 3, "approved": 2, "denied": 2, "signed": 1, "review findings": 3}),
}
OCR_FIXES = (("applieant", "applicant"), ("applicantt", "applicant"), ("sponsor 1d", "sponsor id"), ("sponsor ld", "sponsor id"), ("visa gass", "visa class"), ("visa dass", "visa class"), ("registry narne", "registry name"))
