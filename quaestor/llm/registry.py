"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from quaestor.llm import (bpe, decontamination, html_text, language, licenses, lines, minhash, neighbours, packing, quality,
                          resharding, trie, variants)

QUERIES = {
    "op1_bpe_chunks": bpe.query,
    "op2_quality_rules": quality.query,
    "op3_license_scan": licenses.query,
    "op4_resharding": resharding.query,
    "op5_line_dedup": lines.query,
    "op6_html_text": html_text.query,
    "op7_minhash": minhash.query,
    "op8_language_id": language.query,
    "op9_multiprobe": neighbours.query,
    "op10_packing": packing.query,
    "op11_prefix_trie": trie.query,
    "op12_decontamination": decontamination.query,
    "op13_spelling_variants": variants.query,
}

#: DuckDB SQL where SQL can express the operator; the others are tested
#: against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op2_quality_rules": quality.SQL,
    "op11_prefix_trie": trie.SQL,
    "op12_decontamination": decontamination.SQL,
    "op13_spelling_variants": variants.SQL,
}
