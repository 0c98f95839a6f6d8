"""The queries of this subpackage: each callable takes (spark, sf_dir); SQL where an independent engine can express the result."""

from __future__ import annotations

from . import bitpack, bpe, fertility, fixity, langid, mixing, neardup, quality, toxicity, winnow
from .common import table


def queries() -> dict:
    return {
        "op1_merkle_audit": lambda s, d: fixity.op1_merkle_audit(table(s, d, "pages")),
        "op2_toxic_segments": lambda s, d: toxicity.op2_toxic_segments(table(s, d, "documents"), table(s, d, "labels")),
        "op3_near_duplicates": lambda s, d: neardup.op3_near_duplicates(table(s, d, "documents")),
        "op4_byte_bigru_language": lambda s, d: langid.op4_byte_bigru_language(table(s, d, "documents")),
        "op5_bit_packed_ids": lambda s, d: bitpack.op5_bit_packed_ids(table(s, d, "documents")),
        "op6_tokenizer_fertility": lambda s, d: fertility.op6_tokenizer_fertility(table(s, d, "documents")),
        "op7_winnow_fingerprints": lambda s, d: winnow.op7_winnow_fingerprints(table(s, d, "documents")),
        "op8_boosted_quality": lambda s, d: quality.op8_boosted_quality(table(s, d, "documents"), table(s, d, "labels")),
        "op9_curriculum_mix": lambda s, d: mixing.op9_curriculum_mix(table(s, d, "documents")),
        "op10_bpe_round_trip": lambda s, d: bpe.op10_bpe_round_trip(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_merkle_audit": fixity.SQL}
