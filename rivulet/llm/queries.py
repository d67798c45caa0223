"""The operators' queries over whole tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from rivulet.llm import alignment, exact, jaccard, language, leaks, licences, linededup, lm, minmax, pieces, repeats, secrets, turntrie
from rivulet.llm.tables import documents

QUERIES = {
    "op1_ngram_jaccard": lambda spark, sf_dir: jaccard.similar_groups(documents(spark, sf_dir)),
    "op2_language_id": lambda spark, sf_dir: language.language_report(documents(spark, sf_dir)),
    "op3_licence_scan": lambda spark, sf_dir: licences.licence_scan(documents(spark, sf_dir)),
    "op4_line_dedup": linededup.line_dedup_report,
    "op5_suffix_dedup": lambda spark, sf_dir: repeats.repeats_report(documents(spark, sf_dir)),
    "op6_exact_dedup": lambda spark, sf_dir: exact.exact_duplicates(documents(spark, sf_dir)),
    "op7_gru_scoring": lambda spark, sf_dir: lm.likelihood_report(documents(spark, sf_dir)),
    "op8_sentencepiece": lambda spark, sf_dir: pieces.encode(documents(spark, sf_dir)),
    "op9_decontamination": leaks.leak_report,
    "op10_secret_scan": lambda spark, sf_dir: secrets.secret_report(documents(spark, sf_dir)),
    "op11_min_max_near": lambda spark, sf_dir: minmax.near_duplicates(documents(spark, sf_dir), n=4),
    "op12_turn_trie": lambda spark, sf_dir: turntrie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")),
    "op13_token_alignment": lambda spark, sf_dir: alignment.align_tokenizers(documents(spark, sf_dir)),
}

ORACLES = {
    "op1_ngram_jaccard": jaccard.ORACLE,
    "op4_line_dedup": linededup.ORACLE,
    "op5_suffix_dedup": repeats.ORACLE,
    "op6_exact_dedup": exact.ORACLE,
    "op10_secret_scan": secrets.oracle(),
    "op11_min_max_near": minmax.ORACLE,
    "op12_turn_trie": turntrie.ORACLE,
}
