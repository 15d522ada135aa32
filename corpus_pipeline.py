"""From raw documents to packed training sequences, stage by stage.

Quality rules reject documents, then one of each group of equal texts stays, then
one of each component of near copies; entities and revealing terms are replaced in
what is left, and it is packed.

Defined results: documents with a null or empty text fail the rules and go. Of
equal texts the largest id stays, of near copies the smallest; a null id loses
against any other in both. Repeated rows are one document after the second stage.
Very long texts take the ways that the operators' docstrings state. Columns other
than id, text and n_chars pass through all stages but the last as they are,
whatever their names; n_chars is counted anew once personal data is replaced. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import documents, stored
from txnlake.llm.op2_quality_rules import keep_good
from txnlake.llm.op3_jaccard_join import keep_one_of_each_component
from txnlake.llm.op6_best_fit_packing import pack
from txnlake.llm.op8_pii import sanitise
from txnlake.llm.op10_exact_dedup import keep_one_copy


def _without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = sanitise(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean


#: Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
STAGES = [
    ("quality_rules", lambda spark, docs, sf_dir: keep_good(docs)),
    ("exact_dedup", lambda spark, docs, sf_dir: keep_one_copy(docs)),
    ("jaccard_join", lambda spark, docs, sf_dir: keep_one_of_each_component(docs)),
    ("pii", _without_personal_data),
    ("best_fit_packing", lambda spark, docs, sf_dir: pack(docs)),
]

#: Tokens and similarity components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each writes its result before the next one reads it."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
