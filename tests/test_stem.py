"""Porter2 English stemmer: pinned reference pairs and published examples."""

import pytest

from lexiq.functions.stem import stem_english


@pytest.mark.parametrize("word,stem", [
    ("strange", "strang"), ("body", "bodi"), ("running", "run"), ("caresses", "caress"), ("ponies", "poni"),
    ("ties", "tie"), ("generously", "generous"), ("communication", "communic"), ("consistency", "consist"),
    ("knightly", "knight"), ("dying", "die"), ("news", "news"), ("apple", "appl"), ("hopeful", "hope"),
])
def test_stem(word, stem):
    assert stem_english(word) == stem


def test_stem_dictionary_job(spark):
    from lexiq.functions.stem import stem_dictionary
    df = spark.createDataFrame([("strange",), ("body",), ("strange",)], "term string")
    d = {r.term: r.stem for r in stem_dictionary(df, "en").collect()}
    assert d == {"strange": "strang", "body": "bodi"}
