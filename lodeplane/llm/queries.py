"""The queries of this package and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodeplane.llm.alignment import op11_cross_tokenizer_alignment
from lodeplane.llm.decontam import OP8_SQL, op8_benchmark_decontamination
from lodeplane.llm.fingerprint import op7_closed_syncmer_fingerprints
from lodeplane.llm.grid_join import op13_epsilon_grid_vectors
from lodeplane.llm.html import op1_line_block_html
from lodeplane.llm.langid import op9_kneser_ney_language_id
from lodeplane.llm.licenses import op5_patience_license_scan
from lodeplane.llm.ngram_join import op3_minhash_ngram_join
from lodeplane.llm.packing import op4_min_bin_slack_packing
from lodeplane.llm.pii import op10_disclosure_sanitisation
from lodeplane.llm.sharding import op6_hypergeometric_sharding
from lodeplane.llm.spelling import op12_spelling_variants
from lodeplane.llm.urls import op2_url_ngram_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_block_html,
        op2_url_ngram_filter,
        op3_minhash_ngram_join,
        op4_min_bin_slack_packing,
        op5_patience_license_scan,
        op6_hypergeometric_sharding,
        op7_closed_syncmer_fingerprints,
        op8_benchmark_decontamination,
        op9_kneser_ney_language_id,
        op10_disclosure_sanitisation,
        op11_cross_tokenizer_alignment,
        op12_spelling_variants,
        op13_epsilon_grid_vectors,
    )
}

ORACLES: dict[str, str] = {"op8_benchmark_decontamination": OP8_SQL}
