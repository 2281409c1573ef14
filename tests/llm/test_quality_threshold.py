"""The threshold of the log-likelihood ratio, with mislabelled trusted rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lexiq.llm import quality

from test_operators import prose


@pytest.mark.parametrize("mislabelled", [1, 3, 6])
def test_mislabelled_trusted_rows_do_not_switch_the_ratio_off(spark, mislabelled):
    rng = random.Random(2)
    junk = [f"z{i}%%% " for i in range(400)]
    rows = [(i, prose(rng, 150)) for i in range(200)]
    rows += [(1000 + i, "".join(rng.choice(junk) for _ in range(150))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(100)] + [(1000 + i,) for i in range(mislabelled)], "doc_id long")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(df, trusted).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[1000 + i] for i in range(60))


def test_trusted_copies_count_once(spark):
    """Much copied trusted texts don't narrow the spread of the others."""
    rng = random.Random(4)
    rows = [(i, prose(rng, 150)) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality.quality_rules(df, df.select("doc_id")).collect()
    assert all(r.kept for r in out if r.doc_id < 60)


def test_threshold_of_steps():
    steps, n = np.array([300, 100, 200, -9000]), np.array([50, 20, 28, 2])
    assert abs(quality.threshold_of(steps, n) - (0.02 - 5 * 0.01)) < 1e-12
    assert abs(quality.threshold_of(np.array([200]), np.array([7])) - (0.02 - 5 * quality.LEAST_SPREAD)) < 1e-12
    assert quality.threshold_of(np.array([], int), np.array([], int)) == -math.inf
