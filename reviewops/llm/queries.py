"""The registered queries of this package and their DuckDB twins, where SQL has one."""

from __future__ import annotations

from reviewops.llm.op1_substring import op1_substring_dedup
from reviewops.llm.op2_language import op2_language
from reviewops.llm.op3_simhash import op3_simhash
from reviewops.llm.op4_benchmark import OP4_SQL, op4_decontamination
from reviewops.llm.op5_secrets import op5_secrets
from reviewops.llm.op6_lines import OP6_SQL, op6_line_dedup
from reviewops.llm.op7_pii import op7_pii
from reviewops.llm.op8_embeddings import op8_embedding_dedup
from reviewops.llm.op9_bpe import op9_bpe
from reviewops.llm.op10_urls import op10_url_filter
from reviewops.llm.op11_phrases import OP11_SQL, op11_phrases
from reviewops.llm.op12_sentencepiece import op12_sentencepiece
from reviewops.llm.op13_whitening import op13_whitening

QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_language, op3_simhash, op4_decontamination, op5_secrets, op6_line_dedup, op7_pii,
    op8_embedding_dedup, op9_bpe, op10_url_filter, op11_phrases, op12_sentencepiece, op13_whitening)}
ORACLE = {"op4_decontamination": OP4_SQL, "op6_line_dedup": OP6_SQL, "op11_phrases": OP11_SQL}
