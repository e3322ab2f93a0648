"""The registered queries of this package and their SQL."""

from hedonic.llm import ann, bpe, dac, linededup, merkle, neighbours, packing, phrases, rules, sharding, simhash, tokencount, urlfilter

QUERIES = {
    "op1_token_counts": tokencount.op1_token_counts,
    "op2_quality_rules": rules.op2_quality_rules,
    "op3_nearest_neighbours": ann.op3_nearest_neighbours,
    "op4_simhash_dedup": simhash.op4_simhash_dedup,
    "op5_token_binary": dac.op5_token_binary,
    "op6_bpe_codec": bpe.op6_bpe_codec,
    "op7_quality_classifier": neighbours.op7_quality_classifier,
    "op8_url_filters": urlfilter.op8_url_filters,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op9_sharding": sharding.op9_sharding,
    "op11_line_dedup": linededup.op11_line_dedup,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_phrase_collocations": phrases.op13_phrase_collocations,
}
ORACLES = {
    "op2_quality_rules": rules.OP2_SQL,
    "op8_url_filters": urlfilter.OP8_SQL,
    "op11_line_dedup": linededup.OP11_SQL,
    "op13_phrase_collocations": phrases.OP13_SQL,
}
