"""The training-data queries: one opN_<name> per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontaminate, infill, ngram_join, pieces, quality, resample, secrets, shards, substrings, tokenfile, tries, urls, warc

QUERIES = {
    "op1_token_files": tokenfile.op1,
    "op2_decontamination": decontaminate.op2,
    "op3_warc": warc.op3,
    "op4_quality_rules": quality.op4,
    "op5_ngram_jaccard_join": ngram_join.op5,
    "op6_sharding": shards.op6,
    "op7_secret_scans": secrets.op7,
    "op8_substring_dedup": substrings.op8,
    "op9_pieces": pieces.op9,
    "op10_quality_resampling": resample.op10,
    "op11_infill": infill.op11,
    "op12_url_filter": urls.op12,
    "op13_prefix_trie": tries.op13,
}

ORACLE_SQL = {
    "op2_decontamination": decontaminate.SQL,
    "op3_warc": warc.SQL,
    "op11_infill": infill.SQL,
    "op13_prefix_trie": tries.SQL,
}
