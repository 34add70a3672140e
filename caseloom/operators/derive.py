"""Derived values and the decision: fee, waiver, staleness, risk flags, ordered rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import strict_date


def waiver_class(code: Column) -> Column:
    v = F.upper(F.trim(code))
    return F.when(v.isNull() | (v == ""), "unknown").when(v.rlike("WAIVER|WVR"), "present").when(v.isin("N/A", "NA", "NONE", "-"), "absent").otherwise("unknown")


def fee_from_amount(amount: Column, waiver: Column) -> Column:
    """Null where amount and waiver do not settle the fee."""
    present = waiver == "present"
    return F.when(amount.isNull() & present, "waived").when((amount > 0) & ~present, "paid").when((amount == 0) & present, "waived")


def stale(arrival: Column, received: str = vocab.RECEIVED) -> Column:
    return F.coalesce(F.datediff(F.lit(received).cast("date"), strict_date(arrival)) > vocab.STALE_DAYS, F.lit(False))


def merged_flags(existing: Column, derived: Column) -> Column:
    """Union of two arrays of flags, without ``none``, sorted; ``none`` if empty."""
    both = F.array_sort(F.array_remove(F.array_distinct(F.array_compact(F.array_union(F.coalesce(existing, F.array().cast("array<string>")), F.coalesce(derived, F.array().cast("array<string>"))))), "none"))
    return F.when(F.size(both) > 0, F.array_join(both, "|")).otherwise("none")


def reason_flag(text: Column) -> Column:
    """The one flag that a reason mentions; null for none or several."""
    flags = F.array(*[F.lit(f) for f in (*vocab.DISQUALIFYING, *vocab.REVIEW_ONLY)])
    said = F.filter(flags, lambda f: F.lower(text).contains(f))
    return F.when(F.size(said) == 1, F.element_at(said, 1))


def decision_word(x: Column) -> Column:
    v = F.replace(F.upper(F.trim(x)), F.lit(" "), F.lit("_"))
    v = F.when(v == "REVIEW", "NEEDS_REVIEW").otherwise(v)
    return F.when(v.isin(*vocab.DECISIONS), v)


def adjudicated(note: Column, visa: Column, arrival: Column, flags: Column, fee: Column, sponsor: Column, conflicting: Column) -> Column:
    """(decision, confidence, rule): the first rule that applies. ``flags`` is an array, ``conflicting`` whether a critical field conflicts."""
    other = ~visa.eqNullSafe("DIP-1")
    flags = F.coalesce(flags, F.array().cast("array<string>"))
    has = lambda names: F.arrays_overlap(flags, F.array(*[F.lit(n) for n in names]))
    revoked = F.coalesce(sponsor.isin(*vocab.REVOKED_LISTED, *vocab.REVOKED_INFERRED), F.lit(False))
    said = decision_word(note)
    rules = [
        (said.isNotNull(), said, 0.95, "adjudicator_note"),
        (other & stale(arrival), "DENIED", 0.90, "stale_application"),
        (has(vocab.DISQUALIFYING), "DENIED", 0.93, "disqualifying_risk_flag"),
        (visa.eqNullSafe("TRANSIT-7"), "DENIED", 0.92, "transit_visa_class"),
        (fee.eqNullSafe("unpaid"), "DENIED", 0.92, "unpaid_fee"),
        (revoked & other, "DENIED", 0.76, "revoked_sponsor"),
        (fee.isNull() | (fee == "unknown"), "NEEDS_REVIEW", 0.88, "unresolved_fee"),
        (has(vocab.REVIEW_ONLY), "NEEDS_REVIEW", 0.76, "review_risk_flag"),
        (sponsor.isNull() & other, "NEEDS_REVIEW", 0.70, "missing_sponsor"),
        (visa.isNull() | arrival.isNull() | conflicting, "NEEDS_REVIEW", 0.72, "insufficient_evidence"),
        (fee.isin("paid", "waived"), "APPROVED", 0.82, "clean_packet"),
    ]
    made = lambda d, c, r: F.struct((d if isinstance(d, Column) else F.lit(d)).alias("decision"), F.lit(c).alias("confidence"), F.lit(r).alias("rule"))
    out = F.when(rules[0][0], made(*rules[0][1:]))
    for test, *rest in rules[1:]:
        out = out.when(test, made(*rest))
    return out.otherwise(made("NEEDS_REVIEW", 0.60, "fallback"))
