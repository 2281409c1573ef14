"""Mixing sources to target weights, with DataFrame operations only.

Targets: the sources in code point order (null last) weigh 5, 2, 1, repeating, and share
``SHARE`` of all words. No target passes ``MAX_REPEAT`` times its source's words; what a full
source can't take is shared among the others by weight. That fixpoint is a level: with the
sources sorted by cap / weight, a prefix is full and all others get level * weight.

Draws: the block of a draw is a document. Each source's documents are put into a fixed random
order (a hash of id and text, ranked in ``BINS`` ranges of the hash so that no task ranks a whole
source). A source gives whole passes over its documents and then a prefix of one more, the last
document cut to the words still missing, so it gives its rounded target to the word.

Output shards: the blocks that all sources give are divided by a splitting tree. A node holds the
block quota of every source and halves its shards; the left half's blocks are one draw from the
multivariate hypergeometric distribution (first for runs of ``SOURCES`` sources, then source by source, each
a univariate hypergeometric draw by inverting its distribution, eight standard deviations to either
side), the right half gets the rest. The leaves add up exactly, and shard k takes from every source the next run of its
permuted blocks, so no block is drawn twice. A shard is shuffled by sorting on a hash.

Null text has size 0 and is never drawn, like an empty one; a null source is a source. Repeated
rows are documents of their own. An empty table gives no rows. Columns but id, text and source are ignored
by ``mix`` and kept by ``mixed_documents`` (those named like its own are replaced). More than
``MAX_SOURCES`` sources are an error: their targets, one small row each, are ranked in one task. All random numbers are hashes of
ids, texts and node numbers, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_table_path
from .common import documents, small, stored, without

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MAX_REPEAT = (5, 2, 1), 1.5, 2
N_SHARDS, BINS, SEED = 16, 4096, 42
DEVIATIONS = 8
#: Quotas in a row of the splitting tree; and the most sources: the targets rank one row per source in a task.
SOURCES, MAX_SOURCES = 512, 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """63-bit hash that orders the documents of a source."""
    return F.xxhash64(F.lit(SEED), doc_id, text).bitwiseAND(F.lit((1 << 63) - 1))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_blocks, target, passes, rest) from rows (source, size); one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.when(F.col("size") > 0, 1)).alias("n_blocks"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("ordinal", position).withColumn("weight", F.get(weights, F.col("ordinal") % len(WEIGHTS)))
    per = per.withColumn("cap", F.lit(float(MAX_REPEAT)) * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "ordinal")
    total = F.lit(SHARE) * F.sum("source_size").over(Window.partitionBy())
    left = total - F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", left / open_weight)
    is_full = F.col("cap") <= F.col("level") * F.col("weight")
    level = F.max(F.when(~is_full, F.col("level"))).over(Window.partitionBy())
    per = per.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))))
    words = F.round("target").cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    return per.select("source", "ordinal", "source_size", "n_blocks", "target",
                      F.floor(words / size).cast("long").alias("passes"), (words % size).alias("rest"))


def permuted(sizes: DataFrame) -> DataFrame:
    """``sizes`` (doc_id, source, size, key) with ``rank`` and ``before``: the blocks and the words that
    come earlier in the permuted order of the row's source."""
    binned = sizes.withColumn("bin", F.shiftright("key", 63 - (BINS.bit_length() - 1)))
    block = F.when(F.col("size") > 0, 1).otherwise(0)
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("source", "bin").agg(F.sum("size").alias("w"), F.sum(block).alias("n")).select(
        F.col("source").alias("_s"), F.col("bin").alias("_b"),
        F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("_w"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n"))
    inside = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = (binned.withColumn("rank", F.coalesce(F.sum(block).over(inside), F.lit(0)))
              .withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))))
    return (ranked.join(bins, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_b")))
            .withColumn("rank", F.col("rank") + F.col("_n")).withColumn("before", F.col("before") + F.col("_w"))
            .drop("_s", "_b", "_w", "_n", "bin"))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` blocks out of ``total`` are among the ``good`` ones, for a uniform ``u``."""
    n, k, d = (c.cast("double") for c in (total, good, draws))
    mean = d * k / F.greatest(n, F.lit(1.0))
    spread = DEVIATIONS * F.sqrt(F.greatest(
        mean * (1 - k / F.greatest(n, F.lit(1.0))) * (n - d) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0))) + 1
    least = F.greatest(F.lit(0), draws - (total - good), F.floor(mean - spread))
    most = F.least(draws, good, F.ceil(mean + spread))
    support = F.sequence(least, most)
    up = lambda p, x: p * (k - x) * (d - x) / ((x + 1) * F.greatest(n - k - d + x + 1, F.lit(1.0)))
    weight = F.aggregate(
        support, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum")),
        lambda a, x: F.struct(up(a["p"], x.cast("double")).alias("p"), (a["sum"] + a["p"]).alias("sum")),
        lambda a: a["sum"])
    # the point to stop at is part of the state: an expression inside the step would be evaluated at each step
    state = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), least.alias("k"), (u * weight).alias("stop"))
    return F.aggregate(support, state, lambda a, x: F.struct(
        up(a["p"], x.cast("double")).alias("p"), (a["sum"] + a["p"]).alias("sum"),
        F.when(a["sum"] <= a["stop"], x).otherwise(a["k"]).alias("k"), a["stop"].alias("stop")), lambda a: a["k"])


def _drawn(quotas: Column, draws: Column, *seed: Column) -> Column:
    """A multivariate hypergeometric draw of ``draws`` from an array of quotas: an array of the same length."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(total.alias("total"), draws.alias("draws"), F.lit(0).alias("i"),
                     F.array().cast("array<bigint>").alias("left"))

    def draw(a: Column, good: Column) -> Column:
        u = F.xxhash64(F.lit(SEED), *seed, a["i"]).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
        # the draw is bound once, by an array of one, and then used three times
        return F.get(F.transform(F.array(hypergeometric(a["total"], good, a["draws"], u)), lambda x: F.struct(
            (a["total"] - good).alias("total"), (a["draws"] - x).alias("draws"), (a["i"] + 1).alias("i"),
            F.concat(a["left"], F.array(x)).alias("left"))), F.lit(0))

    return F.aggregate(quotas, start, draw, lambda a: a["left"])


def splitting_tree(quotas: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """(ordinal, bounds): shard k takes the permuted blocks ``bounds[k]`` to ``bounds[k + 1]`` of the source.
    ``quotas`` (ordinal, quota) has one row per source.

    A node's sources are rows of ``SOURCES`` quotas each. A node draws first how many blocks its left half
    takes from each such row, then every row draws for its own sources: no task holds all sources' quotas, and
    no array is longer than ``SOURCES`` or the number of such rows."""
    quota = F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "quota"))), lambda s: s["quota"])
    node = quotas.groupBy(F.floor(F.col("ordinal") / SOURCES).alias("part")).agg(quota.alias("q")).select(
        F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"), "part", "q")
    width = n_shards
    shards, mid = F.col("hi") - F.col("lo"), F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    while width > 1:
        node = stored(node, "splitting_tree")
        total = lambda q: F.aggregate(q, F.lit(0).cast("long"), lambda a, x: a + x)
        parts = F.sort_array(F.collect_list(F.struct("part", total("q").alias("n"))))
        heads = (node.groupBy("lo", "hi").agg(parts.alias("parts"))
                 .withColumn("n", F.transform("parts", lambda x: x["n"]))
                 .withColumn("draws", F.floor(total("n") * (mid - F.col("lo")) / shards).cast("long"))
                 .withColumn("left", _drawn(F.col("n"), F.col("draws"), F.col("lo"), F.col("hi"), F.lit(-1)))
                 .select("lo", "hi", F.inline(F.arrays_zip(F.col("parts.part").alias("part"), F.col("left").alias("draws")))))
        node = node.join(heads, ["lo", "hi", "part"]).withColumn("mid", mid).withColumn(
            "left", _drawn(F.col("q"), F.col("draws"), F.col("lo"), F.col("hi"), F.col("part")))
        halves = F.array(F.struct("lo", F.col("mid").alias("hi"), "part", F.col("left").alias("q")),
                         F.struct(F.col("mid").alias("lo"), "hi", "part", F.zip_with("q", "left", lambda q, x: q - x).alias("q")))
        single = F.array(F.struct("lo", "hi", "part", "q"))
        node = node.select(F.explode(F.when(shards > 1, halves).otherwise(single)).alias("n")).select("n.*")
        width = (width + 1) // 2
    leaves = node.select(F.col("lo").alias("shard"), "part", F.posexplode("q").alias("at", "blocks")).select(
        "shard", (F.col("part") * SOURCES + F.col("at")).cast("int").alias("ordinal"), "blocks")
    upto = Window.partitionBy("ordinal").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = leaves.withColumn("end", F.sum("blocks").over(upto))
    return ends.groupBy("ordinal").agg(
        F.concat(F.array(F.lit(0).cast("long")), F.transform(
            F.sort_array(F.collect_list(F.struct("shard", "end"))), lambda s: s["end"])).alias("bounds"))


def mix(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) as (doc_id, source, ordinal, rank, key, size, source_size,
    target, draws); ``draws`` has one struct (copy, words, shard) per time the mix takes the document.
    (ordinal, rank) is the source's number and the place among its blocks, unique for rows with words."""
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                               row_key(F.col("doc_id"), F.col("text")).alias("key")), "sizes")
    sources = stored(targets(sizes), "targets")
    if sources.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    ranked = stored(permuted(sizes), "permuted")
    one = lambda table: table.withColumnRenamed("source", "_source")
    on = F.col("source").eqNullSafe(F.col("_source"))
    given = (ranked.join(small(one(sources.select("source", "rest"))), on)
             .filter((F.col("size") > 0) & (F.col("before") < F.col("rest")))
             .groupBy("source").agg(F.count(F.lit(1)).alias("part")))
    quotas = (sources.join(one(given), on, "left").select(
        "ordinal", (F.col("passes") * F.col("n_blocks") + F.coalesce("part", F.lit(0))).alias("quota")))
    plan = stored(sources.join(splitting_tree(quotas, n_shards), "ordinal"), "mix_plan")
    x = ranked.join(small(one(plan)), on).drop("_source")
    partial = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("before")))
    drawn = F.transform(F.sequence(F.lit(0), F.lit(MAX_REPEAT)), lambda j: F.struct(
        j.alias("copy"),
        F.when(j < F.col("passes"), F.col("size")).when(j == F.col("passes"), partial).otherwise(0).alias("words"),
        (F.size(F.filter("bounds", lambda b: b <= j * F.col("n_blocks") + F.col("rank"))) - 1).alias("shard")))
    return x.select("doc_id", "source", "ordinal", "rank", "key", "size", "source_size", "target",
                    F.filter(drawn, lambda d: d["words"] > 0).alias("draws"))


def mixed_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """The mix itself: the columns of ``docs`` once per draw, with ``shard`` and ``shuffle_key``. A cut
    document holds the first words of its text."""
    docs = without(docs, ["shard", "shuffle_key", "draws", "key", "nth"])
    drawn = (mix(docs, n_shards).groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"))
             .agg(F.collect_list(F.struct("draws", "size")).alias("all")))
    keyed = docs.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    rows = keyed.join(drawn, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")))
    # rows that repeat id and text share the key; the n-th of them takes the n-th list of draws
    nth = F.row_number().over(Window.partitionBy("_doc", "_key").orderBy(F.lit(1))) - 1
    rows = rows.withColumn("mine", F.get("all", nth)).withColumn("draw", F.explode("mine.draws"))
    text, words = F.col("text"), F.col("draw.words").cast("int")
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)),
                                F.lit(1), words), "")
    cut = F.when(F.col("draw.words") < F.col("mine.size"), head).otherwise(text)
    out = [cut.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*out, F.col("draw.shard").alias("shard"),
                       F.xxhash64(F.lit(SEED), "draw.shard", "draw.copy", "key").alias("shuffle_key"))


def write_shards(mixed: DataFrame, path: str) -> None:
    """Folders ``shard=K``, each shuffled by ``shuffle_key``; a shard may be several tasks. ``mixed`` has a row
    per draw: whole documents (``mixed_documents``) or what draws them (``drawn_rows``)."""
    (mixed.repartitionByRange("shard", "shuffle_key").sortWithinPartitions("shard", "shuffle_key")
     .drop("shuffle_key").write.partitionBy("shard").parquet(path))


def drawn_rows(mixed: DataFrame) -> DataFrame:
    """(ordinal, rank, doc_id, copy, words, shard, shuffle_key) of every draw of ``mix``."""
    rows = mixed.select("doc_id", "ordinal", "rank", "key", F.explode("draws").alias("d"))
    return rows.select("ordinal", "rank", "doc_id", "d.copy", "d.words", "d.shard",
                       F.xxhash64(F.lit(SEED), "d.shard", "d.copy", "key").alias("shuffle_key"))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The draws that ``write_shards`` wrote, with their ``shard``."""
    return spark.read.schema("ordinal int, rank long, doc_id long, copy int, words long, shard int").parquet(path)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards are written, shuffled, as lists of draws; what the mix takes is read back from them."""
    mixed = stored(mix(documents(spark, sf_dir)), "mix")
    path = new_table_path(spark, "mix_shards")
    write_shards(drawn_rows(mixed), path)
    taken = read_shards(spark, path).groupBy("ordinal", "rank").agg(
        F.sum("words").alias("words"), F.sort_array(F.collect_list("shard")).alias("shards"))
    rows = mixed.select("doc_id", "size", "source_size", "target", "ordinal", F.when(F.col("size") > 0, F.col("rank")).alias("rank"))
    return rows.join(taken, ["ordinal", "rank"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken"),
        F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))
