"""The registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from gazette.llm import op12_divergence as op12
from gazette.llm import op13_trie as op13
from gazette.llm import op5_licences as op5
from gazette.llm import op7_quality as op7
from gazette.llm.op1_sharding import op1_sharding
from gazette.llm.op2_decontaminate import op2_decontaminate
from gazette.llm.op3_near_dup import op3_near_dup
from gazette.llm.op4_pieces import op4_pieces
from gazette.llm.op6_pages import op6_pages
from gazette.llm.op8_toxicity import op8_toxicity
from gazette.llm.op9_token_files import op9_token_files
from gazette.llm.op10_secrets import op10_secrets
from gazette.llm.op11_personal import op11_personal

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_decontaminate": op2_decontaminate,
    "op3_near_dup": op3_near_dup,
    "op4_pieces": op4_pieces,
    "op5_licences": op5.op5_licences,
    "op6_pages": op6_pages,
    "op7_quality": op7.op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_token_files": op9_token_files,
    "op10_secrets": op10_secrets,
    "op11_personal": op11_personal,
    "op12_divergence": op12.op12_divergence,
    "op13_trie": op13.op13_trie,
}

ORACLES: dict[str, str] = {"op5_licences": op5.ORACLE, "op7_quality": op7.ORACLE, "op12_divergence": op12.ORACLE, "op13_trie": op13.ORACLE}
