"""Shards of the mix: the splitting tree over many sources, and what is written and read back."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from lexiq.llm import mixing

from test_operators import corpus, docs, empty, words_of  # noqa: F401  (fixtures)


def test_tree_deals_every_block_once_over_parts_of_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES", 4)
    quotas = [(i, (i * 37) % 50) for i in range(23)]
    tree = mixing.splitting_tree(spark.createDataFrame(quotas, "ordinal int, quota long"), 6)
    bounds = {r.ordinal: r.bounds for r in tree.collect()}
    assert sorted(bounds) == list(range(23))
    for i, quota in quotas:
        assert bounds[i][0] == 0 and bounds[i][-1] == quota and len(bounds[i]) == 7 and bounds[i] == sorted(bounds[i])
    sizes = [sum(b[k + 1] - b[k] for b in bounds.values()) for k in range(6)]
    assert max(sizes) - min(sizes) <= 3  # each half is floor or the rest of its node's share


def test_written_shards_are_disjoint_whole_and_shuffled(spark, docs, tmp_path):  # noqa: F811
    mixed = mixing.mix(docs, 4).cache()
    rows = mixing.drawn_rows(mixed)
    path = str(tmp_path / "shards")
    mixing.write_shards(rows, path)
    got = mixing.read_shards(spark, path).collect()
    want = Counter((r.ordinal, r["rank"], d.copy, d.words, d.shard) for r in mixed.collect() for d in r.draws)
    assert Counter((r.ordinal, r["rank"], r["copy"], r.words, r.shard) for r in got) == want
    assert max(want.values()) == 1  # no block is drawn twice
    keys = {(r.ordinal, r["rank"], r["copy"]): r.shuffle_key for r in rows.collect()}
    for shard in range(4):
        files = spark.read.parquet(f"{path}/shard={shard}").withColumn("file", F.input_file_name()).collect()
        by_file: dict[str, list] = {}
        for r in files:
            by_file.setdefault(r.file, []).append(keys[r.ordinal, r["rank"], r["copy"]])
        assert all(k == sorted(k) for k in by_file.values())
        order = [r.ordinal for r in files]
        assert order != sorted(order)  # sources are mixed inside a shard


def test_query_reads_its_shards(spark, tmp_path):
    rows = [(i, t, s) for i, t, s, *_ in corpus()]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op3_mixing(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(words_of(t))) for i, t, _ in rows)
    direct = mixing.mix(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()
    assert Counter((r.doc_id, r.taken, tuple(r.shards)) for r in got) == Counter(
        (r.doc_id, sum(d.words for d in r.draws), tuple(sorted(d.shard for d in r.draws))) for r in direct)
