"""The registered queries of this subpackage and the SQL that some of them must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlake.llm.bpe import op6_bpe
from reviewlake.llm.chat import op1_chat
from reviewlake.llm.decontaminate import op10_decontamination
from reviewlake.llm.fair_mix import op13_fair_mix
from reviewlake.llm.lang_id import op8_language_id
from reviewlake.llm.ngram_join import op3_ngram_join
from reviewlake.llm.oracle import ORACLES
from reviewlake.llm.pii import op7_pii
from reviewlake.llm.quality_rules import op5_quality_rules
from reviewlake.llm.sharding import op2_sharding
from reviewlake.llm.structure import op11_structure_repair
from reviewlake.llm.suffix_dedup import op9_suffix_dedup
from reviewlake.llm.warc import op4_warc
from reviewlake.llm.whitening import op12_whitening


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OPERATORS = (
    op1_chat,
    op2_sharding,
    op3_ngram_join,
    op4_warc,
    op5_quality_rules,
    op6_bpe,
    op7_pii,
    op8_language_id,
    op9_suffix_dedup,
    op10_decontamination,
    op11_structure_repair,
    op12_whitening,
    op13_fair_mix,
)

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {f.__name__: f for f in (*OPERATORS, pipeline)}
