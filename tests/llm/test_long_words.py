"""Texts without white space count to their ends."""

import numpy as np

from siltstone.llm import quality


def test_what_follows_the_first_characters_of_a_word_counts():
    clean = "日本語の文章です。" * 60
    junk = clean[:200] + "#$%&*|<>{}" * 60
    at, value = quality.features(junk)
    other = quality.features(clean)
    assert not (np.array_equal(at, other[0]) and np.allclose(value, other[1]))
    weights = np.zeros(1 << quality.BITS)
    weights[quality.features("#$%&*|<>{}" * 20)[0]] = 5.0
    scorer = quality.Scorer(weights, -1.0, None)
    assert scorer.poor(junk) > 0.5 > scorer.poor(clean)
    assert max(map(len, quality.in_slices(junk.split()))) <= quality.LONGEST and "".join(quality.in_slices(junk.split())) == junk
