"""The corpus queries and their SQL answers, by name."""

from __future__ import annotations

from roomgrid.llm.chat import OP1_SQL, op1_chat_formatting
from roomgrid.llm.embeddings import op6_embedding_near_dedup
from roomgrid.llm.html_text import op4_html_extraction
from roomgrid.llm.jaccard import OP3_SQL, op3_ngram_jaccard_join
from roomgrid.llm.language import op9_language_id
from roomgrid.llm.lines import OP2_SQL, op2_line_dedup
from roomgrid.llm.mixing import OP5_SQL, op5_source_mixing
from roomgrid.llm.nearest import op11_nearest_neighbours
from roomgrid.llm.packing import op7_packing
from roomgrid.llm.periodic import op13_periodic_runs
from roomgrid.llm.quality import OP8_SQL, op8_quality_rules
from roomgrid.llm.repair import op12_conversation_repair
from roomgrid.llm.warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_line_dedup": op2_line_dedup,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_source_mixing": op5_source_mixing,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {
    "op1_chat_formatting": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op3_ngram_jaccard_join": OP3_SQL,
    "op5_source_mixing": OP5_SQL,
    "op8_quality_rules": OP8_SQL,
    "op10_warc": OP10_SQL,
}
