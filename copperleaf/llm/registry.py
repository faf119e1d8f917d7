"""The queries of the text operators, and DuckDB SQL where it can express them."""

from copperleaf.llm import (
    collocations, conversation_trie, decontamination, language_id, near_duplicates, packing, pii, quality_model, quality_rules, secret_scan, sentence_pieces, token_tables, toxicity,
)

QUERIES = {
    f.__name__: f
    for f in (
        secret_scan.op1_secret_scan, quality_rules.op2_quality_rules, quality_model.op3_quality_model, pii.op4_pii, language_id.op5_language_id,
        sentence_pieces.op6_sentence_pieces, toxicity.op7_toxicity, near_duplicates.op8_near_duplicates, token_tables.op9_token_tables,
        decontamination.op10_decontamination, collocations.op11_collocations, packing.op12_packing, conversation_trie.op13_conversation_trie,
    )
}
SQL = {"op2_quality_rules": quality_rules.SQL, "op4_pii": pii.SQL, "op8_near_duplicates": near_duplicates.SQL, "op11_collocations": collocations.SQL, "op13_conversation_trie": conversation_trie.SQL}
