"""Registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.op1_mixing import op1_mixing
from strata.llm.op2_sharding import op2_sharding
from strata.llm.op3_licenses import op3_licenses
from strata.llm.op4_quality import op4_quality
from strata.llm.op5_mih import op5_mih
from strata.llm.op6_imatch import op6_imatch
from strata.llm.op7_jaccard import op7_jaccard
from strata.llm.op8_hmm import op8_hmm
from strata.llm.op9_secrets import op9_secrets
from strata.llm.op10_bpe import op10_bpe
from strata.llm.op11_spelling import op11_spelling
from strata.llm.op12_pieces import op12_pieces
from strata.llm.op13_trie import op13_trie


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_sharding": op2_sharding,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_mih": op5_mih,
    "op6_imatch": op6_imatch,
    "op7_jaccard": op7_jaccard,
    "op8_hmm": op8_hmm,
    "op9_secrets": op9_secrets,
    "op10_bpe": op10_bpe,
    "op11_spelling": op11_spelling,
    "op12_pieces": op12_pieces,
    "op13_trie": op13_trie,
    "pipeline": pipeline,
}

# SQL cannot express these operators on whole tables; the tests in tests/llm
# compare them with brute force, exact round trips or held-out accuracy.
ORACLE: dict[str, str] = {}
