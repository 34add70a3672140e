"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from . import bpe, chat, fingerprint, language, license, neardup, packing, pages, quality, topk

QUERIES = {
    "op1_packing": packing.op1,
    "op2_byte_bpe": bpe.op2,
    "op3_license_scan": license.op3,
    "op4_exact_topk": topk.op4,
    "op5_chat_formatting": chat.op5,
    "op10_neardup": neardup.op10,
    "op6_quality": quality.op6,
    "op7_language": language.op7,
    "op8_html": pages.op8,
    "op9_fingerprints": fingerprint.op9,
}

ORACLE_SQL = {
    "op3_license_scan": license.OP3_SQL,
    "op4_exact_topk": topk.OP4_SQL,
    "op5_chat_formatting": chat.OP5_SQL,
}
