"""Every query of the text operators is compared with SQL or with one of these tests against brute force."""

import importlib
import re

import __spark_entry__ as entry

CHECKED = {
    "op1_separator_scan": "test_tokens_and_shards.test_counts_from_streams_equal_direct_counts",
    "op2_sentencepiece": "test_tokens_and_shards.test_ids_equal_the_library_and_come_back",
    "op3_recurrent_lm": "test_models.test_base_scores_and_held_out_gain",
    "op5_quality_classifier": "test_rule_ensemble.test_rules_and_weights_equal_brute_force",
    "op6_substring_dedup": "test_joins_and_spans.test_spans_with_pieces_equal_brute_force",
    "op8_benchmark_decontamination": "test_latent_retrieval.test_search_equals_an_exhaustive_one",
    "op9_quality_rules": "test_models.test_counts_equal_brute_force",
    "op11_simhash_near_dedup": "test_simhash_grid.test_query_equals_brute_force",
    "op13_embedding_whitening": "test_whitening.test_query_equals_whole_matrices",
    "pipeline": "test_pipeline.test_near_duplicates",
}


def test_every_query_has_sql_or_a_brute_force_test():
    queries = {n for n in entry.queries() if re.match(r"op\d+_", n) or n == "pipeline"}
    assert queries - set(entry.oracle_sql()) == set(CHECKED)
    for place in CHECKED.values():
        module, name = place.split(".")
        assert callable(getattr(importlib.import_module(module), name))
