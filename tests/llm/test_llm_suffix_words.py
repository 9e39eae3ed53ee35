"""Words of the unigram base that workers hold, and those left to the join."""

from haulier.llm import suffix_tree


def test_known_words_are_counted_and_others_listed():
    texts = [[b"a", b"b", b"c", b"b", b"c", b"\n"], [b"\n"], [b"d", b"a", b"\n"]]
    n, rare = suffix_tree.looked_up(texts, {b"a": 5, b"\n": 3})
    assert n.tolist() == [5, 0, 0, 0, 0, 3, 3, 0, 5, 3]
    assert rare.to_pylist() == [[{"word": b"b", "times": 2}, {"word": b"c", "times": 2}], [], [{"word": b"d", "times": 1}]]
