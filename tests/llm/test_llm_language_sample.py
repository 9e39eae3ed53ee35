"""Languages without usable texts and texts of any length in the training sample."""

import random

import numpy as np
from frames import SCHEMA
from test_llm_models import ENGLISH, GERMAN, held_out, two_languages

from haulier.llm import language_crf


def test_a_language_without_words_does_not_stop_the_training(spark):
    rows = two_languages(random.Random(1))
    free = [i for i in range(900, 940) if not held_out(i, 4)]
    rows.append((free[0], "12 34 ... 5", "xx", "s", 1))
    # The only text of a language is longer than a training text may be.
    rng = random.Random(2)
    french = "le la les des une est dans pour qui sur avec pas".split()
    rows.append((free[1], " ".join(rng.choice(french) for _ in range(language_crf.LONGEST + 5000)), "fr", "s", 1))
    field = language_crf.fitted(spark.createDataFrame(rows, SCHEMA))
    assert field.languages == ["de", "en", "fr", "xx"]
    assert np.abs(field.weights).max() > 0 and np.abs(field.transitions).max() > 0
    names, _ = language_crf.Tagger(field).texts([" ".join(ENGLISH), " ".join(GERMAN), " ".join(french)])
    assert names == ["en", "de", "fr"]
    assert np.abs(field.weights[language_crf.features("avecment")][:, 2]).max() > 0.01
