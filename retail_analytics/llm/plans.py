"""The registered queries of the numbered operators and, where SQL can express them, their DuckDB oracles."""
from __future__ import annotations

from . import bpe, cross_align, decontaminate, html_text, jaccard_join, merkle, multi_index, quality, revisits, substring_dedup, token_count, toxicity, url_filter

QUERIES = {"op1_url_filter": url_filter.query, "op2_warc_revisits": revisits.query, "op3_byte_bpe": bpe.query,
           "op4_token_counts": token_count.query, "op5_jaccard_join": jaccard_join.query, "op6_html_extraction": html_text.query,
           "op7_toxicity": toxicity.query, "op8_substring_dedup": substring_dedup.query, "op9_quality_rules": quality.query,
           "op10_decontamination": decontaminate.query, "op11_merkle_manifest": merkle.query,
           "op12_cross_alignment": cross_align.query, "op13_multi_index": multi_index.query}
SQL = {"op1_url_filter": url_filter.sql, "op2_warc_revisits": revisits.sql, "op10_decontamination": decontaminate.sql,
       "op11_merkle_manifest": merkle.sql}
