"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.llm import oracle
from bazaarlens.llm.bpe import op6_bpe
from bazaarlens.llm.chat import op9_chat
from bazaarlens.llm.jaccard import op8_jaccard
from bazaarlens.llm.languages import op13_language
from bazaarlens.llm.lattice import op1_lattice
from bazaarlens.llm.licenses import op10_licenses
from bazaarlens.llm.mixing import op2_mixing
from bazaarlens.llm.phrases import op11_phrases
from bazaarlens.llm.pii import op3_pii
from bazaarlens.llm.prefixes import op12_prefixes
from bazaarlens.llm.sentences import op5_sentences
from bazaarlens.llm.topk import op7_topk
from bazaarlens.llm.toxicity import op4_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, over its whole table."""
    found = (
        op1_lattice,
        op2_mixing,
        op3_pii,
        op4_toxicity,
        op5_sentences,
        op6_bpe,
        op7_topk,
        op8_jaccard,
        op9_chat,
        op10_licenses,
        op11_phrases,
        op12_prefixes,
        op13_language,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {
        "op1_lattice": oracle.LATTICE,
        "op7_topk": oracle.TOP_K,
        "op8_jaccard": oracle.JACCARD,
        "op9_chat": oracle.CHAT,
        "op11_phrases": oracle.PHRASES,
        "op12_prefixes": oracle.PREFIXES,
    }
