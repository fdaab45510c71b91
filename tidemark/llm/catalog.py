"""Queries of this package and their SQL twins."""

from __future__ import annotations

from tidemark.llm.hamming import SQL as CODES_SQL
from tidemark.llm.hamming import op6_exact_codes
from tidemark.llm.html_text import op1_html_text
from tidemark.llm.language import op2_language
from tidemark.llm.mixing import SQL as MIXING_SQL
from tidemark.llm.mixing import op5_mix_sources
from tidemark.llm.neighbours import op4_nearest
from tidemark.llm.ngrams import op3_ngram_join
from tidemark.llm.pieces import op10_sentencepiece
from tidemark.llm.quality import op13_quality
from tidemark.llm.repeats import SQL as REPEATS_SQL
from tidemark.llm.repeats import op12_periodic_runs
from tidemark.llm.sharding import op7_shard_documents
from tidemark.llm.spelling import SQL as SPELLING_SQL
from tidemark.llm.spelling import op11_spelling_variants
from tidemark.llm.tokenfile import op9_token_files
from tidemark.llm.toxicity import op8_toxicity

QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_language, op3_ngram_join, op4_nearest, op5_mix_sources, op6_exact_codes, op7_shard_documents, op8_toxicity,
    op9_token_files, op10_sentencepiece, op11_spelling_variants, op12_periodic_runs, op13_quality)}
ORACLE = {"op5_mix_sources": MIXING_SQL, "op6_exact_codes": CODES_SQL, "op11_spelling_variants": SPELLING_SQL,
          "op12_periodic_runs": REPEATS_SQL}
