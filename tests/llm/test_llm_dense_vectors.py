"""Links between dense groups of vectors, and what happens if no audit passes."""

import numpy as np
from test_llm_near import exact_links

from haulier.llm import nn_descent


def answers(spark, vectors, **options):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = nn_descent.near_vectors(df, **options).collect()
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr), exact_links(df.collect())


def test_links_between_groups_wider_than_the_longest_list(spark):
    rng = np.random.default_rng(3)
    a, b, c = np.linalg.qr(rng.standard_normal((24, 3)))[0].T
    centres = [a, 0.94 * a + np.sqrt(1 - 0.94**2) * b, c]
    vectors = np.concatenate([m + 0.004 * rng.standard_normal((80, 24)) for m in centres])
    got, want = answers(spark, vectors)
    assert len({x[2] for x in want}) == 2 and want[0][1] == 159
    assert got == want


def test_without_a_passed_audit_all_pairs_are_compared(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 24))
    vectors = np.concatenate([base, base + 0.2 * rng.standard_normal((60, 24)), rng.standard_normal((900, 24))])
    got, want = answers(spark, vectors, rounds=0)
    assert got == want
