"""The queries of this package and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from . import decontaminate, language, licenses, lines, mixing, near_duplicates, negatives, neighbours, spelling, substrings, tokens, urls, warc

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_substring_dedup": substrings.op3_substring_dedup,
    "op4_near_duplicates": near_duplicates.op4_near_duplicates,
    "op5_language_id": language.op5_language_id,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_nearest_neighbours": neighbours.op8_nearest_neighbours,
    "op9_token_counts": tokens.op9_token_counts,
    "op10_url_filter": urls.op10_url_filter,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_warc": warc.op12_warc,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}
SQL = {"op1_mix_sources": mixing.OP1_SQL, "op2_decontaminate": decontaminate.OP2_SQL, "op3_substring_dedup": substrings.OP3_SQL, "op4_near_duplicates": near_duplicates.OP4_SQL, "op7_line_dedup": lines.OP7_SQL, "op12_warc": warc.OP12_SQL, "op13_hard_negatives": negatives.OP13_SQL}
