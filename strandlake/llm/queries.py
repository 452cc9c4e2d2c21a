"""Queries of this subpackage, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from strandlake.llm import byte_bpe, chat_format, collocations, cross_tokenizer, exact_dedup, html_extract, minhash_dedup, passage_dedup, quality_rules, secret_scan, source_mix, token_files, url_filter

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_html_extract": html_extract.op2_html_extract,
    "op3_minhash_dedup": minhash_dedup.op3_minhash_dedup,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_passage_dedup": passage_dedup.op6_passage_dedup,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_source_mix": source_mix.op8_source_mix,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_chat_format": chat_format.op10_chat_format,
    "op11_cross_tokenizer": cross_tokenizer.op11_cross_tokenizer,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_url_filter": url_filter.op13_url_filter,
    "quality_ablation": quality_rules.quality_ablation,
}

ORACLE_SQL = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op3_minhash_dedup": minhash_dedup.OP3_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op10_chat_format": chat_format.OP10_SQL,
    "op12_phrase_collocations": collocations.OP12_SQL,
    "op13_url_filter": url_filter.OP13_SQL,
    "quality_ablation": quality_rules.ABLATION_SQL,
}
