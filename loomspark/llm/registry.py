"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, chat, collocations, fingerprints, lines, mixing, nearcopies, negatives, quality, rules, sharding, substrings, urls

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_quality": quality.op2_quality,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_quality_rules": rules.op4_quality_rules,
    "op5_fingerprints": fingerprints.op5_fingerprints,
    "op6_repeats": substrings.op6_repeats,
    "op7_url_filters": urls.op7_url_filters,
    "op8_near_copies": nearcopies.op8_near_copies,
    "op9_bpe": bpe.op9_bpe,
    "op10_sharding": sharding.op10_sharding,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_chat": chat.op12_chat,
    "op13_collocations": collocations.op13_collocations,
}
SQL: dict[str, str] = {"op3_line_dedup": lines.SQL3, "op7_url_filters": urls.SQL7, "op8_near_copies": nearcopies.SQL8, "op11_hard_negatives": negatives.SQL11, "op12_chat": chat.SQL12, "op13_collocations": collocations.SQL13}
