"""The stages of the corpus pipeline, each against brute force on what its predecessor kept."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from lexiq.llm import quality

from test_operators import brute_base, brute_components, brute_leaks, brute_targets, plain_ids, prose, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(21)
    texts = [prose(rng, rng.randint(60, 260)) for _ in range(50)]
    items = [prose(rng, 30), prose(rng, 45)]
    texts += [prose(rng, 80) + " " + items[0] + " " + prose(rng, 60), prose(rng, 90) + "\n" + items[1]]
    base = texts[4].split()
    for i in range(6):  # near copies
        words = list(base)
        words[i * 7 % len(words)] = f"edit{i}"
        texts.append(" ".join(words))
    texts += [texts[9]] * 3 + [None, "", "too short", "again and " * 200]
    rows = [(i, t, "en", [None, "a", "b"][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, prose(rng, 100), None, "a", 1), (None, None, None, None, None), rows[12]]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(52)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The rows before the first stage and after each; the input has extra columns named like operators' own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for i, (name, stage) in enumerate(P.STAGES):
        if i == 0:
            docs = docs.selectExpr("*", "true AS kept", "7 AS node", "0.5 AS score", "1 AS shard")
        docs = P.stored(stage(spark, docs, sf_dir), name, None)
        out.append(docs.collect())
        assert docs.columns == (P.COLUMNS if i < 4 else docs.columns)
    return out


def rows(found):
    return Counter((r.doc_id, r.text) for r in found)


def test_quality_rejects_what_the_base_rules_and_the_ratio_reject(steps, spark, sf_dir):
    before, after = steps[0], steps[1]
    fails = lambda t: len(words_of(t)) < 50 or brute_base(t)[-1]
    kept = rows(r for r in before if not fails(r.text))
    assert not rows(after) - kept
    verdict = quality.quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), quality.trusted_ids(spark, sf_dir))
    assert rows(after) == rows(verdict.filter("kept").collect())
    assert rows(verdict.filter("NOT base_failed").collect()) == kept


def test_one_of_every_group_of_near_copies_stays(steps):
    before, after = steps[1], steps[2]
    links = brute_components([(r.doc_id, r.text) for r in before])
    groups = defaultdict(list)
    for r, (_, _, component) in zip(before, links):
        groups[component].append((r.doc_id is None, r.doc_id or 0, r.text))
    assert rows(after) == Counter((None if none else i, t) for none, i, t in map(min, groups.values()))


def test_documents_with_an_item_go(steps, spark, sf_dir):
    before, after = steps[2], steps[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {doc for doc, _ in brute_leaks([(r.doc_id, r.text) for r in before], items)}
    assert len(leaks) == 2
    assert rows(after) == rows(r for r in before if r.doc_id not in leaks)


def test_mix_takes_its_targets(steps):
    before, after = steps[3], steps[4]
    sizes, taken = Counter(), Counter()
    whole = {r.doc_id: r.text for r in before}
    for r in before:
        sizes[r.source] += len(words_of(r.text))
    for r in after:
        taken[r.source] += len(words_of(r.text))
        assert whole[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert all(abs(taken[s] - t) <= 1 for s, t in brute_targets(sizes).items())


def test_tokens_are_those_of_the_mix(steps):
    before, after = steps[4], steps[5]
    ids = plain_ids([r.text for r in before])
    want = Counter((r.doc_id, len(x) + 1, zlib.crc32(np.array([*x, 1], "<u4").tobytes())) for r, x in zip(before, ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in after) == want


def test_run_is_its_stages(spark, sf_dir, steps):
    got = Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in P.run(spark, sf_dir).collect())
    assert got == Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in steps[5])


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, sf_dir), "empty", None)
        assert docs.count() == 0
