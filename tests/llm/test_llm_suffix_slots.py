"""Windows that workers hold: none is lost to another, and as many are held as may be."""

import numpy as np
import pyarrow as pa
import pytest

from haulier.llm import suffix_tree


@pytest.mark.parametrize("slots", [1, 5, 1000, 1024])
def test_no_window_is_lost_to_another(slots):
    keys = np.random.default_rng(3).choice(1 << 56, 1000, replace=False).astype(np.int64)
    log_p = -np.arange(1.0, 1001.0)
    held = suffix_tree.Slots(keys, np.arange(1000) % 7, log_p, slots)
    values, known = held.look_up(np.concatenate([keys, keys + 1, keys]))
    assert known.tolist() == [*[True] * 1000, *np.isin(keys + 1, keys).tolist(), *[True] * 1000]
    assert np.array_equal(values[:1000], log_p) and np.array_equal(values[2000:], log_p) and not values[~known].any()


def test_as_many_are_held_as_may_be(spark):
    counts = spark.createDataFrame([(n,) for n in [0] * 5 + [1] * 40 + [9] * 10 + [15] * 20 + [300]], "n long")
    for most, rows in ((0, 0), (1, 1), (20, 1), (21, 21), (30, 21), (31, 31), (70, 31), (71, 71), (1000, 71)):
        least = suffix_tree.least_frequency(counts, most)
        assert counts.where(suffix_tree.frequency() >= least).count() == rows
    assert suffix_tree.least_frequency(counts.where("n < 0"), 5) == 0


def test_words_are_those_of_the_tokens():
    texts = ["", " ", "\n\t", " A  b c\x0b\x0cD\r\n", "ÄÖ É\x1cx\x00y b", " Z\u0085q", "x\x1fy\x1d z", "İI K b B"]
    for some in (texts, ["", " "], ["b"]):
        bodies, words = suffix_tree.spelled_words(pa.array(some))
        assert words.to_pylist() == [[*suffix_tree.tokens(t), suffix_tree.END] for t in some]
        assert bodies == [b" ".join(t) for t in words.to_pylist()]
