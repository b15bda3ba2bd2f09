"""The registered queries of this folder and their DuckDB SQL, where SQL can express them."""

from . import (
    collocations,
    decontaminate,
    fingerprint,
    lang_id,
    line_dedup,
    near_dup,
    packing,
    pii,
    simhash_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
    va_cluster,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_lang_id": lang_id.op3_lang_id,
    "op4_fingerprint": fingerprint.op4_fingerprint,
    "op5_near_dup": near_dup.op5_near_dup,
    "op6_packing": packing.op6_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op8_proximity": decontaminate.op8_proximity,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_pii": pii.op10_pii,
    "op11_collocations": collocations.op11_collocations,
    "op12_clusters": va_cluster.op12_clusters,
    "op13_simhash_dedup": simhash_dedup.op13_simhash_dedup,
}

ORACLE = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op9_url_filter": url_filter.OP9_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op12_clusters": va_cluster.OP12_SQL,
}
