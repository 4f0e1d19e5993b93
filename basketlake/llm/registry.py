"""The queries of this package and the SQL they are compared with."""

from __future__ import annotations

import corpus_pipeline
from basketlake.llm import chat, decontaminate, language, licenses, packing, pieces, quality, repair, sharding, simhash, spelling, topk, toxicity

QUERIES = {
    "op1_simhash_dedup": simhash.op1,
    "op2_chat_format": chat.op2,
    "op3_exact_topk": topk.op3,
    "op4_histogram_shards": sharding.op4,
    "op5_binary_packing": packing.op5,
    "op6_language_id": language.op6,
    "op7_quality_resampling": quality.op7,
    "op8_decontamination": decontaminate.op8,
    "op9_toxicity": toxicity.op9,
    "op10_license_scan": licenses.op10,
    "op11_spelling_variants": spelling.op11,
    "op12_piece_offsets": pieces.op12,
    "op13_structure_repair": repair.op13,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op2_chat_format": chat.OP2_SQL, "op3_exact_topk": topk.OP3_SQL, "op8_decontamination": decontaminate.OP8_SQL}
