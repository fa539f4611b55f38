"""The operators' queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.bpe import op4_bpe
from tidemart.llm.decontaminate import op12_decontamination
from tidemart.llm.exact import op6_exact_dedup
from tidemart.llm.fertility import op8_fertility
from tidemart.llm.masked import op10_masked_lm
from tidemart.llm.merkle import op11_merkle
from tidemart.llm.minhash import op2_near_dedup
from tidemart.llm.mixing import op1_mixing
from tidemart.llm.oracles import ORACLES
from tidemart.llm.pii import op7_pii
from tidemart.llm.planes import op9_bitplane
from tidemart.llm.quality import op5_quality
from tidemart.llm.shipping import ship
from tidemart.llm.spelling import op13_spelling
from tidemart.llm.toxicity import op3_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_mixing,
        op2_near_dedup,
        op3_toxicity,
        op4_bpe,
        op5_quality,
        op6_exact_dedup,
        op7_pii,
        op8_fertility,
        op9_bitplane,
        op10_masked_lm,
        op11_merkle,
        op12_decontamination,
        op13_spelling,
    )
}

__all__ = ["ORACLES", "QUERIES"]
