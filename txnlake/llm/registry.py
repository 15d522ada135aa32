"""The operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnlake.llm import op1_language_id as op1
from txnlake.llm import op2_quality_rules as op2
from txnlake.llm import op3_jaccard_join as op3
from txnlake.llm import op4_byte_bpe as op4
from txnlake.llm import op5_license_scan as op5
from txnlake.llm import op6_best_fit_packing as op6
from txnlake.llm import op7_sharding as op7
from txnlake.llm import op8_pii as op8
from txnlake.llm import op9_token_counts as op9
from txnlake.llm import op10_exact_dedup as op10
from txnlake.llm import op11_prefix_trie as op11
from txnlake.llm import op12_fill_in_middle as op12
from txnlake.llm import op13_document_fingerprints as op13
from txnlake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": lambda s, d: op1.language_id(documents(s, d)),
        "op2_quality_rules": lambda s, d: op2.quality_rules(documents(s, d)),
        "op3_jaccard_join": lambda s, d: op3.jaccard_components(documents(s, d)).drop("text_hash", "component"),
        "op4_byte_bpe": lambda s, d: op4.digests(op4.encode(documents(s, d))),
        "op5_license_scan": lambda s, d: op5.license_scan(documents(s, d)),
        "op6_best_fit_packing": lambda s, d: op6.pack(documents(s, d)),
        "op7_sharding": lambda s, d: op7.shard(documents(s, d)),
        "op8_pii": lambda s, d: op8.pii(documents(s, d)),
        "op9_token_counts": lambda s, d: op9.token_counts(documents(s, d)),
        "op10_exact_dedup": lambda s, d: op10.exact_dedup(documents(s, d)),
        "op11_prefix_trie": lambda s, d: op11.prefix_trie(op11.conversations(s, d)),
        "op12_fill_in_middle": lambda s, d: op12.digests(documents(s, d)),
        "op13_document_fingerprints": lambda s, d: op13.against_next(documents(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": op2.ORACLE_SQL,
        "op10_exact_dedup": op10.ORACLE_SQL,
        "op11_prefix_trie": op11.ORACLE_SQL,
        "op12_fill_in_middle": op12.ORACLE_SQL,
    }
