"""Texts without spaces are one word, and all of it counts."""

import random

from frames import SCHEMA
from test_llm_models import ENGLISH, GERMAN, two_languages

from haulier.llm import language_crf


def test_the_second_half_of_an_unspaced_text_decides(spark):
    df = spark.createDataFrame(two_languages(random.Random(1)), SCHEMA)
    tagger = language_crf.Tagger(language_crf.fitted(df))
    neutral = "x" * 5000
    rng = random.Random(2)
    for words, lang in ((ENGLISH, "en"), (GERMAN, "de")):
        text = neutral + "".join(rng.choice(words) for _ in range(2000))[:5000]
        assert len(text) > 9_000 and tagger.texts([text])[0] == [lang]
    assert set(language_crf.features("ab" * 50 + "cd")) - set(language_crf.features("ab" * 50 + "ab"))
