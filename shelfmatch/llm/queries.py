"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from shelfmatch.llm import decontaminate, language, main_text, near, piece_coding, quality, ranking, records, substrings, token_counts, url_filter, warc, whitening


def queries() -> dict:
    return {
        "op1_quality": quality.op1_quality,
        "op2_near_duplicates": near.op2_near_duplicates,
        "op3_records": records.op3_records,
        "op4_main_text": main_text.op4_main_text,
        "op5_warc": warc.op5_warc,
        "op6_language": language.op6_language,
        "op7_contamination": decontaminate.op7_contamination,
        "op8_token_counts": token_counts.op8_token_counts,
        "op9_piece_coding": piece_coding.op9_piece_coding,
        "op10_url_filter": url_filter.op10_url_filter,
        "op11_substring_dedup": substrings.op11_substring_dedup,
        "op12_whitening": whitening.op12_whitening,
        "op13_ranked_search": ranking.op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": warc.OP5_SQL, "op7_contamination": decontaminate.OP7_SQL,
            "op11_substring_dedup": substrings.OP11_SQL, "op13_ranked_search": ranking.OP13_SQL}
