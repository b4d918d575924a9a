"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from skuflow.llm.ann import op8_nearest
from skuflow.llm.fingerprints import op4_fingerprints
from skuflow.llm.lexical import ORACLE_OP13, op13_lexical_search
from skuflow.llm.mixing import op10_mix_sources
from skuflow.llm.near_dup import ORACLE_OP6, op6_near_duplicates
from skuflow.llm.parity_join import ORACLE_OP11, op11_jaccard_join
from skuflow.llm.pieces import op3_pieces
from skuflow.llm.pii import ORACLE_OP5, op5_pii
from skuflow.llm.records import op9_token_records
from skuflow.llm.repair import op12_conversation_repair
from skuflow.llm.repeats import ORACLE_OP2, op2_repeats
from skuflow.llm.toxicity import op1_toxicity
from skuflow.llm.url_filter import ORACLE_OP7, op7_url_filter

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_repeats": op2_repeats,
    "op3_pieces": op3_pieces,
    "op4_fingerprints": op4_fingerprints,
    "op5_pii": op5_pii,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_url_filter": op7_url_filter,
    "op8_nearest": op8_nearest,
    "op9_token_records": op9_token_records,
    "op10_mix_sources": op10_mix_sources,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL = {
    "op2_repeats": ORACLE_OP2,
    "op5_pii": ORACLE_OP5,
    "op6_near_duplicates": ORACLE_OP6,
    "op7_url_filter": ORACLE_OP7,
    "op11_jaccard_join": ORACLE_OP11,
    "op13_lexical_search": ORACLE_OP13,
}
