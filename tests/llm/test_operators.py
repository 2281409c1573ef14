"""Operators of the llm subpackage against brute force, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiq.llm import (chat, components, decontaminate, mixing, ngram_join, quality, repeats, sharding, token_counts,
                       token_files, toxicity)
from lexiq.llm import words as W
from lexiq.llm.tokens import encoder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, source string, kept boolean, score double, shard int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(NAMES) + rng.choice(["", "", "", ".", ","]) + rng.choice([" ", " ", " ", "\n"])
                   for _ in range(n)).strip()


def corpus() -> list[tuple]:
    """Clean prose, exact and near copies, shared passages, junk, nulls, empty and long texts."""
    rng = random.Random(5)
    texts: list[str | None] = [prose(rng, rng.randint(60, 200)) for _ in range(40)]
    passage = prose(rng, 70)
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 40) for _ in range(6)]
    base = texts[3].split()
    for i in range(12):  # near copies: one to several words replaced
        words = list(base)
        for j in range(i):
            words[(11 * j + 7 * i) % len(words)] = f"edit{i}x{j}"
        texts.append(" ".join(words))
    texts += [texts[5]] * 4 + [texts[6].upper(), texts[6]]
    texts += [None, "", " \t\n", "one", "One", "a b c d", "A b  c d", "a b c", "é ñ 日本  x", "x" * 5000,
              "to be " * 400, "line one here\n" * 30, "#*$%&|<> " * 20, prose(rng, 9000), "<|endoftext|> Don't STOP..., now!"]
    rows = [(i, t, f"s{i % 3}", None, 1.5, 7) for i, t in enumerate(texts)]
    rows += [(None, texts[0], None, None, None, None), (None, prose(rng, 80), None, True, 0.0, 1), rows[8],
             (8, prose(rng, 90), "s1", None, None, None), (9_000_000_000, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


# --- words ---------------------------------------------------------------------------------

def test_words_of_slices():
    texts = [r[1] for r in corpus()] + ["a\x0bb\x0cc\rd", "\x1ca\x85b"]
    found, lower = [], []
    for w in W.slices(pa.array(texts)):
        data = w.data.tobytes()
        for i in range(w.n_docs):
            found.append([data[w.starts[k]:w.ends[k]].decode() for k in range(w.first[i], w.first[i + 1])])
        lower += w.hashes(lower=True).tolist()
    assert found == [words_of(t) for t in texts]
    by_word = defaultdict(set)
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for x, h in zip((x.translate(fold) for f in found for x in f), lower):
        by_word[x].add(h)
    assert all(len(h) == 1 for h in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_slices(monkeypatch):
    texts = pa.array([r[1] for r in corpus()])
    whole = np.concatenate([w.hashes() for w in W.slices(texts)])
    monkeypatch.setattr(W, "SLICE", 64)
    assert (np.concatenate([w.hashes() for w in W.slices(texts)]) == whole).all()


# --- 1 chat ----------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    turns = [(1, 0, "system", None), (1, 1, "user", "hi <|im_end|>\n<|im_start|>assistant<|im_sep|>"),
             (1, 2, "assistant", "a"), (1, 3, "assistant", "b <\\| <|im_part|> <\\\\|"), (1, 3, "assistant", "a tie"),
             (2, None, None, "x"), (2, 1, "as<|si\nst", ""), (2, 1, "as<|si\nst", ""), (3, 5, "assistant", ""),
             (None, 0, "assistant", "日本 €"), (4, 0, "assistant", "y" * 30000)]
    df = spark.createDataFrame([(*t, "extra") for t in turns],
                               "conv_id long, turn long, role string, text string, formatted string")
    out = chat.read_chats(chat.format_chats(df)).collect()
    for r in out:
        mine = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == r.conv_id))
        assert [(t.role, t.text) for t in r.turns] == [m[2:] for m in mine]
        assert sum(m.chars for m in r.loss_mask) == len(r.formatted)
        at, under = 0, ""
        for m in r.loss_mask:
            under += r.formatted[at:at + m.chars] if m.loss else ""
            at += m.chars
        assert re.sub(r"<\\(\\*)\|", r"<\1|", under) == "".join(m[3] for m in mine if m[2] == "assistant")
    merged = next(r for r in out if r.conv_id == 1)
    assert merged.formatted.count("<|im_start|>") == 3 and merged.formatted.count("<|im_part|>") == 2
    assert chat.format_chats(df.limit(0)).count() == 0


# --- 2 n-gram join -----------------------------------------------------------------------------

def shingle_sets(rows):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in rows:
        w = [x.translate(fold) for x in words_of(r[1])]
        yield frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows) -> list[tuple]:
    sets, ids = list(shingle_sets(rows)), [r[0] for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    heads: dict[int, list] = defaultdict(list)
    for i in range(len(rows)):
        heads[find(i)].append(ids[i])
    out = []
    for i in range(len(rows)):
        known = [d for d in heads[find(i)] if d is not None]
        out.append((ids[i], len(sets[i]), (min(known) if known else None) if sets[i] else ids[i]))
    return out


def key(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def test_ngram_components(docs):
    got = [tuple(r) for r in ngram_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(brute_components(corpus()), key=key)


def test_ngram_groups_are_opened(spark, monkeypatch):
    """Without sorted neighbours every link must come from the matrix, the bound and the check."""
    monkeypatch.setattr(ngram_join, "NEIGHBOURS", 1)
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    rng = random.Random(11)
    base = prose(rng, 120).split()
    rows = []
    for i in range(60):  # a cloud of edits with sizes on both sides of the threshold
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(words))
            words[at:at + 1] = [rng.choice(NAMES)] * rng.randint(0, 3)
        rows.append((i, " ".join(words[:rng.randint(95, len(words))]), None, None, None, None))
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == sorted(brute_components(rows))


def test_prefix_bound_holds():
    """A pair that reaches the threshold shares at least the number of prefix tokens that is asked for."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = set(rng.sample(range(200), n))
        b = set(rng.sample(sorted(a), rng.randint(max(1, n - 8), n))) | set(rng.sample(range(200), rng.randint(0, 8)))
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        prefix = lambda s: set(sorted(s)[:len(s) - (80 * len(s) + 99) // 100 + 1])
        rest = lambda m: -(-80 * m // 100) - 1
        asked = -(-80 * (len(a) + len(b)) // 180) - max(rest(len(a)), rest(len(b)))
        assert len(prefix(a) & prefix(b)) >= max(1, asked)


def test_one_of_each(docs, empty):
    left = [tuple(r)[:2] for r in ngram_join.one_of_each(docs).collect()]
    rows, comps = corpus(), brute_components(corpus())
    groups = defaultdict(set)
    for r, c in zip(rows, comps):
        if c[1]:
            groups[c[2] if c[2] is not None else r[1]].add((r[0] is None, r[0] or 0, r[1]))
    assert len([x for x in left if words_of(x[1])]) == len(left) - sum(not words_of(r[1]) for r in rows)
    ids = Counter(x[0] for x in left if words_of(x[1]))
    assert all(ids[c] >= 1 for c in {c[2] for c in comps if c[1] and c[2] is not None})
    assert ids[5] == 1 and ids[8] == 2  # exact copies; two texts that do not link share the id 8
    assert ngram_join.one_of_each(empty).collect() == [] and ngram_join.one_of_each(docs).columns == docs.columns


def test_components_of_chains(spark):
    rng = random.Random(1)
    chain = list(range(300))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(300)} == {0} and {got[i] for i in range(1000, 1100)} == {1000} and got[2001] == 2000
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- 3 mixing --------------------------------------------------------------------------------

def brute_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        for s in full or free:
            target[s] = 2.0 * sizes[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        free -= full or free
    return target


def test_mixing(docs, empty):
    rows = corpus()
    out = mixing.mix(docs, 6).collect()
    sizes: Counter = Counter()
    for r in rows:
        sizes[r[2]] += len(words_of(r[1]))
    want, taken = brute_targets(sizes), Counter()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r[0], len(words_of(r[1]))) for r in rows)
    shards = Counter()
    for r in out:
        mine = sum(d.words for d in r.draws)
        taken[r.source] += mine
        shards.update(d.shard for d in r.draws)
        assert mine <= 2 * r.size and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    assert set(shards) == set(range(6)) and max(shards.values()) - min(shards.values()) <= 6
    again = mixing.mix(docs.repartition(3), 6).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert mixing.mix(empty).collect() == []


def test_mixed_documents(docs):
    mixed = mixing.mixed_documents(docs, 4)
    assert mixed.columns == [c for c in docs.columns if c != "shard"] + ["shard", "shuffle_key"]
    words = Counter()
    whole = defaultdict(set)
    for r in corpus():
        whole[r[0]].add(r[1])
    for r in mixed.collect():
        assert any(t is not None and t.startswith(r.text) for t in whole[r.doc_id])
        words[r.source] += len(words_of(r.text))
    drawn = mixing.mix(docs, 4).select("source", F.expr("aggregate(draws, 0L, (a, d) -> a + d.words)").alias("n"))
    assert words == {r.source: r.n for r in drawn.groupBy("source").agg(F.sum("n").alias("n")).collect()}


def test_hypergeometric_draws(spark):
    cases = [(50, 20, 10), (10, 10, 4), (10, 0, 4), (7, 3, 7), (7, 3, 0), (0, 0, 0), (100_000, 40_000, 50_000)]
    df = spark.range(400).withColumn("u", (F.col("id") + 0.5) / 400)
    for total, good, draws in cases:
        x = [r.x for r in df.select(mixing.hypergeometric(*[F.lit(v).cast("long") for v in (total, good, draws)],
                                                          F.col("u")).alias("x")).collect()]
        assert min(x) >= max(0, draws - (total - good)) and max(x) <= min(draws, good)
        if total > 1:
            mean = draws * good / total
            spread = (mean * (1 - good / total) * (total - draws) / (total - 1)) ** 0.5
            assert abs(np.mean(x) - mean) <= 0.02 * spread + 1e-9 and abs(np.std(x) - spread) <= 0.03 * spread + 1e-9


# --- 4 token counts ----------------------------------------------------------------------------

def plain_ids(texts):
    t = Tokenizer.from_file(TOKENIZER)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_token_counts(docs, empty):
    lengths = [len(i) for i in plain_ids([r[1] for r in corpus()])]
    histogram = token_counts.length_histogram(docs, TOKENIZER)
    assert {r.length: r.n_docs for r in histogram.collect()} == Counter(lengths)
    sums = token_counts.suffix_sums(histogram)
    for r in sums.collect():
        limit = r.context_limit
        assert r.n_docs == lengths.count(limit) and r.n_docs_over == sum(x > limit for x in lengths)
        assert r.tokens_truncated == sum(min(x, limit) for x in lengths) and r.tokens_total == sum(lengths)
        assert r.tokens_over == sum(x for x in lengths if x > limit)
    assert token_counts.quantile(sums, 0.5).first()[0] == sorted(lengths)[(len(lengths) + 1) // 2 - 1]
    assert token_counts.truncated_total(histogram, 100).first()[0] == sum(min(x, 100) for x in lengths)
    assert token_counts.suffix_sums(token_counts.length_histogram(empty, TOKENIZER)).collect() == []


def test_encoder_equals_the_library():
    rng = random.Random(3)
    parts = ["a", "B", "'s", "'S", ".", ",", "...", "<|endoftext|>", "<|ENDOFTEXT|>", "<", " ", "\n", "\x0b", " ",
             "é", "é", "́", "İ", "ß", "Σ", "1", "23", "٣", "#", "ﬁ", "日本", "😀", "​", "\x85", "क़"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [None]
    want, k = plain_ids(texts), 0
    for w in W.slices(pa.array(texts)):
        ids, n = encoder(TOKENIZER).encode(w, 1)
        for a, b in zip(np.cumsum(n) - n, np.cumsum(n)):
            assert ids[a:b].tolist() == want[k] + [1]
            k += 1
    assert k == len(texts)


def test_encoder_of_a_tokenizer_that_keeps_spaces():
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, t = encoder(path), Tokenizer.from_file(path)
    assert not e.by_word
    texts = ["a b  c", "", None, "Hello, World"]
    for w in W.slices(pa.array(texts)):
        ids, n = e.encode(w, 7)
        assert ids.tolist() == [i for x in texts for i in t.encode(x or "", add_special_tokens=False).ids + [7]]
        assert (e.lengths(w) == n - 1).all()


# --- 5 quality ---------------------------------------------------------------------------------

def brute_base(text: str | None) -> tuple:
    t = text or ""
    w = words_of(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    triples = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality_base_columns(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long")
    out = quality.quality_rules(docs, none)
    assert Counter((r.doc_id, *(r[c] for c in quality.BASE), r.base_failed) for r in out.collect()) == Counter(
        (r[0], *brute_base(r[1])) for r in corpus())
    assert all(r.kept == (not r.base_failed) for r in out.collect())  # without a target the base rules decide
    assert quality.quality_rules(empty, none).collect() == []


def test_quality_ratio_rejects_junk(spark):
    rng = random.Random(2)
    junk = [f"z{i}%%% " for i in range(400)]
    rows = [(i, prose(rng, 150)) for i in range(120)]
    rows += [(1000 + i, "".join(rng.choice(junk) for _ in range(150))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(5,), (None,)], "doc_id long")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(df, trusted).collect()}
    assert all(kept[i] for i in range(120)) and not any(kept[1000 + i] for i in range(30))
    # the score is the mean of log ratios with a trusted document's own counts taken out
    raw, target = quality.multinomials(quality.mark_trusted(df, trusted))
    assert raw.sum() == sum(2 * len(words_of(t)) - 1 for _, t in rows)
    assert target.sum() == sum(2 * len(words_of(t)) - 1 for i, t in rows if i < 60)
    model = quality.Ratio(raw, target)
    for i in (3, 70):
        w = next(W.slices(pa.array([rows[i][1]])))
        bucket = quality.features(w)[0]
        own = np.bincount(bucket, minlength=quality.BUCKETS) if i < 60 else 0 * target
        t = (target - own + 1.0) / ((target - own).sum() + quality.BUCKETS)
        r = (raw + 1.0) / (raw.sum() + quality.BUCKETS)
        assert abs(np.log(t[bucket] / r[bucket]).mean() - model.scores(w, np.array([i < 60]))[0]) < 1e-9


# --- 6 decontamination -----------------------------------------------------------------------

def brute_leaks(rows, items) -> dict:
    out = {}
    fold = lambda t: words_of((t or "").lower())
    for item_id, text in items:
        w = fold(text)
        m = len(w) - 4
        if m < 1:
            continue
        item = Counter(tuple(w[i:i + 5]) for i in range(m))
        for r in rows:
            d = fold(r[1])
            s = [tuple(d[i:i + 5]) for i in range(len(d) - 4)]
            best = 0.0
            for i in range(len(s) - m + 1):
                both = sum((Counter(s[i:i + m]) & item).values())
                best = max(best, both / (2 * m - both))
            if best >= 0.8 - 1e-12:
                out[r[0], item_id] = max(best, out.get((r[0], item_id), 0))
    return out


def test_leaks(spark, docs, empty):
    rng = random.Random(9)
    rows = [r for r in corpus() if r[1] is None or len(r[1]) < 3000]
    items = [(i, prose(rng, rng.choice([5, 6, 9, 17, 40, 40, 63]))) for i in range(14)]
    items += [(50, None), (51, ""), (52, "too short"), (53, items[4][1]), (54, "go go go go go go go go")]
    leaks = []
    for i, (_, text) in enumerate(items[:14] + items[-1:]):
        words = text.upper().split()
        leaks.append((500 + i, prose(rng, 20) + " " + " ".join(words) + "\n" + prose(rng, 30)))
        words[len(words) // 2] = "changed"
        leaks.append((600 + i, prose(rng, 20) + " " + " ".join(words)))
        leaks.append((700 + i, " ".join(words[1:]) + " " + prose(rng, 5)))
    rows += [(*x, None, None, None, None) for x in leaks] + [(None, leaks[0][1], None, None, None, None)]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    df = spark.createDataFrame(rows, DOCS)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_leaks(df, bench).collect()}
    want = brute_leaks(rows, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and len(got) > 20
    left = {(r.doc_id, r.text) for r in decontaminate.without_leaks(df, bench).collect()}
    assert left == {(r[0], r[1]) for r in rows if r[0] not in {k[0] for k in want}}
    assert decontaminate.find_leaks(empty, bench).collect() == [] == decontaminate.find_leaks(df, bench.limit(0)).collect()


def test_screen_never_loses_a_window():
    for least in range(1, 60):
        s = decontaminate.safe_stride(least)
        for m in range(least, 400):
            places = min(sum((a + j) % s == 0 for j in range(m)) for a in range(s))
            assert places > decontaminate.most_missing(m)


# --- 7 token files -----------------------------------------------------------------------------

def test_token_files(spark, docs, empty):
    path = token_files.token_files(docs, TOKENIZER)
    rows = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [x + [1] for x in plain_ids([r[1] for r in rows])]
    starts = np.cumsum([0] + [len(x) for x in ids])
    got = token_files.read(spark, path).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids) for r in got] == [
        (r[0], s, len(x), x) for r, s, x in zip(rows, starts.tolist(), ids)]
    digests = token_files.digests(token_files.read(spark, path)).orderBy("start").collect()
    assert [r.ids_crc32 for r in digests] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert token_files.read(spark, token_files.token_files(empty, TOKENIZER)).collect() == []


def test_token_file_layout(spark, docs):
    import pyarrow.parquet as pq
    path = token_files.token_files(docs, TOKENIZER)
    file = next(f for f in spark.read.parquet(path).inputFiles())
    meta = pq.ParquetFile(file.removeprefix("file:")).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["start_in_part"].encodings
    assert all(c.has_offset_index and c.has_column_index for n, c in columns.items() if n == "doc_id")


# --- 8 toxicity ------------------------------------------------------------------------------

def test_toxicity(spark, empty):
    rng = random.Random(4)
    bad = ["vilewretch", "scumbagger", "hatefulness"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = prose(rng, 120).split()
        for j in range(6 * toxic):
            words[rng.randrange(len(words))] = bad[(i + j) % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "!!!"), (None, rows[0][1]), (1003, prose(rng, 9000)), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = spark.createDataFrame(labels + [(0, 0), (7, None)], "doc_id long, toxic int").filter(
        ~toxicity.held_out(F.col("doc_id")))
    model = toxicity.learn(df, train)
    out = toxicity.score(df, model, ["doc_id"]).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    by_id = {r.doc_id: r.score for r in out}
    assert sum((by_id[i] >= 0.3) == bool(t) for i, t in held) >= 0.95 * len(held)
    assert by_id[1000] == by_id[1001] == by_id[1002] and by_id[1003] < 0.3 and by_id[None] == by_id[0]
    assert sorted(toxicity.score(df.repartition(7), model, ["doc_id"]).collect(), key=str) == sorted(out, key=str)
    assert toxicity.learn(df, train.limit(0)) is None
    assert {r.score for r in toxicity.score(df, None, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(empty, model, ["doc_id"]).collect() == []


def test_windows_cover_the_text():
    for text in (r[1] for r in corpus()):
        folded = (text or "").encode().translate(toxicity._FOLD)
        assert b"".join(w[:-1] for w in toxicity.windows((text or "").encode())).split() == folded.split()


# --- 9 sharding ------------------------------------------------------------------------------

def slow_jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump():
    keys = np.random.default_rng(1).integers(0, 1 << 64, 2000, dtype=np.uint64)
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump(keys, n).tolist() == [slow_jump(int(k), n) for k in keys]


def test_shards(spark, docs, empty):
    from lexiq.session import new_table_path
    path = new_table_path(spark, "t")
    sharding.write_shards(docs, path, 4)
    rows = sharding.read_shards(spark, path).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == Counter(r[:3] for r in corpus())
    for s in range(4):
        mine = sorted((r for r in rows if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        ids = [-1 if r.doc_id is None else r.doc_id for r in mine]
        assert ids == sorted(ids)
    for r in rows:
        k = int(W.mix(np.array([-(1 << 63) if r.doc_id is None else r.doc_id], np.int64).view(np.uint64))[0])
        assert r.shard == slow_jump(k, 4) and r.grown_shard == slow_jump(k, 5) and r.grown_shard in (r.shard, 4)
    path = new_table_path(spark, "t")
    sharding.write_shards(empty, path, 4)
    schema = "doc_id long, text string, grown_shard int, place long, shard int"
    assert sharding.read_shards(spark, path, schema).collect() == []


# --- 10 substring dedup ------------------------------------------------------------------------

def brute_repeats(rows) -> Counter:
    first: dict[tuple, float] = {}
    rank = lambda r: float("inf") if r[0] is None else r[0]
    for r in rows:
        w = words_of(r[1])
        for i in range(len(w) - 49):
            k = tuple(w[i:i + 50])
            first[k] = min(first.get(k, float("inf")), rank(r))
    out: Counter = Counter()
    for r in rows:
        w = words_of(r[1])
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i:i + 50])] < rank(r):
                gone.update(range(i, i + 50))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[r[0], len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()] += 1
    return out


def test_repeats(docs, empty):
    got = repeats.find_repeats(docs).collect()
    want = brute_repeats(corpus())
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert sum(k[2] for k in want) > 500 and repeats.find_repeats(empty).collect() == []


def test_repeats_of_periodic_and_hot_passages(spark):
    rng = random.Random(8)
    hot, loop = prose(rng, 55), "tick tock " * 60
    rows = [(i, prose(rng, rng.randint(0, 30)) + " " + hot + " " + prose(rng, 10)) for i in range(40)]
    rows += [(100 + i, prose(rng, 10) + " " + loop[: 300 + 37 * i]) for i in range(8)]
    rows += [(200, hot), (199, hot + " x"), (201, " ".join(hot.split()[:50])), (202, " ".join(hot.split()[:49]))]
    got = repeats.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_repeats(rows)


def test_anchors_of_equal_windows_agree():
    rng = random.Random(6)
    window = prose(rng, 50).split()
    picks = []
    for _ in range(20):
        text = " ".join(prose(rng, rng.randint(0, 40)).split() + window + prose(rng, rng.randint(0, 40)).split())
        w = next(W.slices(pa.array([text])))
        words, (at, _) = words_of(text), repeats.anchors(w, w.hashes())
        begin = next(i for i in range(len(words)) if words[i:i + 50] == window)
        picks.append({int(a) - begin for a in at if begin <= a <= begin + 40})
    assert set.intersection(*picks)


def test_rows_are_rows(docs):
    """Extra columns named like an output are replaced, the others stay."""
    out = quality.quality_rules(docs, docs.select("doc_id").limit(0))
    assert out.columns.count("kept") == 1 and "source" in out.columns and "shard" in out.columns
    assert isinstance(out.first(), Row)
