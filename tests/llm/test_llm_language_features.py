"""What the tagger remembers of words that differ in their marks."""

import random

import numpy as np

from haulier.llm import language_crf

def test_a_word_is_looked_up_once_with_its_marks():
    field = language_crf.train({}, np.zeros((language_crf.LEXICON, 2)), ["x", "y"])
    tagger = language_crf.Tagger(field)
    tagger.texts(["word word, (word 12 -", "word, 12"])
    assert set(tagger._ids) == {"word", "word,", "(word", "12", "-"}
    assert len({tagger._ids[w] for w in ("word", "word,", "(word")}) == 1 and tagger._ids["12"] == tagger._ids["-"] == -1
    assert tagger._used == 1


def test_a_memory_that_is_emptied_gives_the_same_labels(monkeypatch):
    rng = random.Random(5)
    texts = {lang: [["".join(rng.choices(letters, k=4)) for _ in range(60)] for _ in range(5)] for lang, letters in (("x", "abcd"), ("y", "cdef"))}
    field = language_crf.train(texts, np.zeros((language_crf.LEXICON, 2)), ["x", "y"], steps=5)
    lines = [" ".join(rng.choice(["", "("]) + w + rng.choice(["", ",", "!"]) for w in words) + " 12 -" for t in texts.values() for words in t] + ["", "12"]
    want = language_crf.Tagger(field).words(lines)
    monkeypatch.setattr(language_crf, "MEMORY_WORDS", 150)
    tagger = language_crf.Tagger(field)
    for line, (words, p) in zip(lines, want, strict=True):
        assert words == language_crf.words_of(line)
        got = tagger.words([line])[0]
        assert got[0] == words and np.allclose(got[1], p)
