"""Golden values of the preset pairs."""

import pytest

from entitylink import api

GOLDEN = {
    "typos": {"name_ratio": 80.0, "name_token_sort_ratio": 80.0, "name_token_set_ratio": 83.3333, "name_jaccard": 0.25, "name_char_3gram_jaccard": 0.4737, "addr_token_set_ratio": 75.7576, "addr_ratio": 69.6970, "addr_jaccard": 0.3636, "addr_char_3gram_jaccard": 0.4091, "num_jaccard": 0.6667, "addr_num_exact": 0, "name_legal_stem_ratio": 85.7143, "postal_code_match": 0},
    "landmark": {"name_ratio": 76.4706, "name_token_sort_ratio": 79.4118, "name_token_set_ratio": 79.4118, "name_jaccard": 0.2857, "name_char_3gram_jaccard": 0.3778, "addr_token_set_ratio": 65.4206, "addr_ratio": 54.2056, "addr_jaccard": 0.1765, "addr_char_3gram_jaccard": 0.2048, "num_jaccard": 0.5, "addr_num_exact": 1, "name_legal_stem_ratio": 81.8182, "postal_code_match": 1},
    "accents": {"name_ratio": 88.5714, "name_token_sort_ratio": 88.5714, "name_token_set_ratio": 100.0, "name_jaccard": 0.6667, "name_char_3gram_jaccard": 0.7647, "addr_token_set_ratio": 95.6522, "addr_ratio": 78.9474, "addr_jaccard": 0.75, "addr_char_3gram_jaccard": 0.7073, "num_jaccard": 1.0, "addr_num_exact": 1, "name_legal_stem_ratio": 95.3846, "postal_code_match": 1},
    "other unit": {"name_ratio": 90.9091, "name_token_sort_ratio": 90.9091, "name_token_set_ratio": 92.0, "name_jaccard": 0.6, "name_char_3gram_jaccard": 0.7586, "addr_token_set_ratio": 96.7033, "addr_ratio": 95.7447, "addr_jaccard": 0.7778, "addr_char_3gram_jaccard": 0.8367, "num_jaccard": 1.0, "addr_num_exact": 1, "name_legal_stem_ratio": 100.0, "postal_code_match": 1},
}


def test_golden_features(spark):
    rows = {r["s1_id"].split("#")[0]: r.asDict() for r in api.match_live(spark, api.EXAMPLES).collect()}
    assert set(rows) == set(GOLDEN)
    for title, expected in GOLDEN.items():
        for name, value in expected.items():
            assert rows[title][name] == pytest.approx(value, abs=1e-3), (title, name)
