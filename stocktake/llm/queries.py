"""Registered queries of the operators, and their SQL where SQL can express them."""

from stocktake.llm import decontaminate, dialogue, html, jaccard, licenses, mixing, periodic, quality, sharding, sql, suffixes, token_files, toxicity, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_mixing": mixing.op2_mixing,
    "op3_quality": quality.op3_quality,
    "op4_suffixes": suffixes.op4_suffixes,
    "op5_sharding": sharding.op5_sharding,
    "op6_jaccard": jaccard.op6_jaccard,
    "op7_html": html.op7_html,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_licenses": licenses.op10_licenses,
    "op11_periodic": periodic.op11_periodic,
    "op12_tokens": token_files.op12_tokens,
    "op13_dialogue": dialogue.op13_dialogue,
}
ORACLE = {
    "op1_warc": sql.OP1,
    "op2_mixing": mixing.OP2_SQL,
    "op4_suffixes": sql.OP4,
    "op5_sharding": sharding.OP5_SQL,
    "op6_jaccard": sql.OP6,
    "op7_html": sql.OP7,
    "op10_licenses": sql.OP10,
    "op11_periodic": periodic.OP11_SQL,
    "op13_dialogue": dialogue.OP13_SQL,
}
