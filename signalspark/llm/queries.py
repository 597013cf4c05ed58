"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from signalspark.llm.decontaminate import op5_benchmark_decontamination
from signalspark.llm.jaccard_join import op3_ngram_jaccard_join
from signalspark.llm.langid import op1_language_id
from signalspark.llm.license_scan import ORACLE as OP2_ORACLE
from signalspark.llm.license_scan import op2_license_scan
from signalspark.llm.line_dedup import op7_line_dedup
from signalspark.llm.merkle import ORACLE as OP12_ORACLE
from signalspark.llm.merkle import op12_merkle_manifest
from signalspark.llm.packing import op8_best_fit_packing
from signalspark.llm.quality import op11_quality_classifier
from signalspark.llm.resample import op13_importance_resampling
from signalspark.llm.secret_scan import ORACLE as OP9_ORACLE
from signalspark.llm.secret_scan import op9_secret_scan
from signalspark.llm.token_count import op4_token_counts
from signalspark.llm.vector_dedup import op6_embedding_near_dedup
from signalspark.llm.wavelet import op10_token_id_files

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_token_counts": op4_token_counts,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_id_files": op10_token_id_files,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": OP2_ORACLE,
    "op9_secret_scan": OP9_ORACLE,
    "op12_merkle_manifest": OP12_ORACLE,
}
