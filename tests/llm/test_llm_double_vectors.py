"""Vectors of doubles beyond the range of floats."""

import numpy as np
from test_llm_dense_vectors import answers


def test_components_beyond_float_range_keep_their_links(spark):
    vectors = np.random.default_rng(6).standard_normal((20, 12))
    vectors = np.concatenate([vectors, vectors + 0.1])
    got, want = answers(spark, vectors * 1e150)
    assert got == want and sum(x[1] for x in want) > 0
