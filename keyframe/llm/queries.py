"""The registered queries of this subpackage, and their SQL."""

import corpus_pipeline
from keyframe.llm import hard_negatives, licenses, secrets
from keyframe.llm.decontaminate import op6_decontaminate
from keyframe.llm.jaccard import op1_jaccard
from keyframe.llm.language import op7_language
from keyframe.llm.mixing import op9_mixing
from keyframe.llm.passages import op2_passages
from keyframe.llm.quality import op5_quality
from keyframe.llm.suffix_dedup import op10_suffix_dedup
from keyframe.llm.token_counts import op8_token_counts
from keyframe.llm.toxicity import op12_toxicity
from keyframe.llm.whitening import op13_whitening

QUERIES = {
    "op1_jaccard": op1_jaccard,
    "op2_passages": op2_passages,
    "op3_secrets": secrets.op3_secrets,
    "op4_licenses": licenses.op4_licenses,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_language": op7_language,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op3_secrets": secrets.OP3_SQL,
    "op4_licenses": licenses.OP4_SQL,
    "op11_hard_negatives": hard_negatives.OP11_SQL,
}
