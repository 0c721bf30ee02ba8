import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import frame, row, sentences
from chainlake.llm import graph, neardup


def brute_classes(texts, idf, threshold=neardup.THRESHOLD):
    sets = {d: neardup.shingles(neardup.words_of(pa.array([t], pa.string()))[0], idf) for d, t in texts}
    parent = {d: d for d, _ in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where, pairs = defaultdict(list), Counter()
    for d, (h, _) in sets.items():
        for x in h.tolist():
            where[x].append(d)
    for ds in where.values():
        pairs.update((a, b) for i, a in enumerate(ds) for b in ds[:i])
    for a, b in pairs:
        if neardup.weighted_jaccard(sets[a], sets[b]) >= threshold:
            parent[find(a)] = find(b)
    out = defaultdict(set)
    for d in parent:
        out[find(d)].add(d)
    return {frozenset(x) for x in out.values()}


def grouped(found):
    out = defaultdict(set)
    for r in found:
        out[r.class_id].add(r.doc_id)
    return {frozenset(x) for x in out.values()}


def test_words_are_those_of_a_pattern():
    texts = ["The CAT_2 sat!", "", None, "É è-x", "end", "start mid"]
    hashes, at = neardup.words_of(pa.array(texts, pa.string()))
    words = [re.findall(r"[0-9a-z_]+|[^\W]+", (t or "").lower()) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    by = dict(zip([w for ws in words for w in ws], hashes.tolist(), strict=True))
    assert len(set(by.values())) == len(by)
    again = neardup.words_of(pa.array(["x the cat_2"], pa.string()))[0]
    assert again[1:].tolist() == [by["the"], by["cat_2"]]


def test_weights_and_similarity():
    idf = np.full(neardup.BUCKETS, 2.0)
    words = neardup.words_of(pa.array(["a b c d e a b c d e f"], pa.string()))[0]
    h, w = neardup.shingles(words, idf)
    assert len(h) == 6 and sorted(w.tolist()) == [2.0] * 5 + [4.0]
    short = neardup.shingles(words[:2], idf)
    assert len(short[0]) == 1 and neardup.weighted_jaccard(short, short) == 1 and neardup.weighted_jaccard((h, w), short) == 0


def test_samples_estimate_the_similarity():
    rng = np.random.default_rng(1)
    sampler, total = neardup.Sampler(neardup.FINE), 0
    for _ in range(20):
        h = np.sort(rng.integers(0, 2**63, 400, dtype=np.uint64))
        a, b = rng.random(400) * 3 + 0.5, rng.random(400) * 3 + 0.5
        b[:300] = a[:300]
        same = (sampler.sample(h, a) == sampler.sample(h, b)).mean()
        total += same - neardup.weighted_jaccard((h, a), (h, b))
    assert abs(total / 20) < 0.02


def test_packed_samples_count_equals(spark):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**63, 2 * neardup.PACK * neardup.LONGS, dtype=np.uint64).reshape(2, -1) * np.uint64(2)
    b[::3] = a[::3]
    want = int(((a >> np.uint64(61)) == (b >> np.uint64(61))).sum())
    one = spark.createDataFrame([(neardup.packed(a).tolist(), neardup.packed(b).tolist())], "a array<long>, b array<long>")
    assert one.select(neardup._equal("a", "b", neardup.LONGS).alias("n")).first().n == want


def test_classes_of_the_small_table_are_the_brute_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    idf = neardup.inverse_frequencies(docs)
    found = neardup.near_duplicates(docs).collect()
    texts = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert grouped(found) == brute_classes(texts, idf)
    assert sum(r.kept for r in found) == len(grouped(found))


@pytest.mark.parametrize("hot", [neardup.HOT, 20])
def test_a_large_group(spark, monkeypatch, hot):
    """Two hundred copies of one text, each with its own small changes: one class, though most pairs are less alike than the threshold."""
    monkeypatch.setattr(neardup, "HOT", hot)
    rng = random.Random(11)
    base = " ".join(sentences(rng, 20)).split()
    rows = [row(0, " ".join(base))]
    for i in range(1, 200):
        words = list(base)
        for _ in range(rng.randint(1, 5)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append(row(i, " ".join(words)))
    shared = " ".join(base[:12])
    rows += [row(1000 + i, shared + " " + " ".join(sentences(rng, 3))) for i in range(60)]  # they share a passage, and stay apart
    docs = frame(spark, rows)
    found = neardup.near_duplicates(docs).collect()
    assert grouped(found) == brute_classes([(r[0], r[1]) for r in rows], neardup.inverse_frequencies(docs))
    assert len([r for r in found if r.class_id == 0]) >= 170


def test_a_hot_bucket_is_compared_whole(spark, monkeypatch):
    """Members of a large bucket that share no further band are compared all the same, as are those that share an ordinary bucket after it."""
    monkeypatch.setattr(neardup, "HOT", 20)
    sign = neardup._signatures
    apart = F.expr(f"concat(slice(bands, 1, {neardup.BANDS}), transform(sequence(1, {neardup.BANDS}), i -> xxhash64(node, i)))")
    monkeypatch.setattr(neardup, "_signatures", lambda docs, idf: sign(docs, idf).withColumn("bands", apart))
    rng = random.Random(13)
    base = " ".join(sentences(rng, 20)).split()
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(3, 9)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append(row(i, " ".join(words)))
    docs = frame(spark, rows)
    found = neardup.near_duplicates(docs).collect()
    assert grouped(found) == brute_classes([(r[0], r[1]) for r in rows], neardup.inverse_frequencies(docs))


def test_few_likely_pairs_are_left_out(spark):
    """The least number of equal samples follows from the threshold: one pair in 10,000 at the threshold has fewer."""
    rng = np.random.default_rng(3)
    for threshold in (0.8, 0.9):
        for longs in (neardup.LONGS, neardup.FINE):
            equal = rng.binomial(neardup.PACK * longs, threshold + (1 - threshold) / 8, 400_000)
            least = neardup.least_equal(threshold, longs)
            assert (equal < least).mean() <= 2 * neardup.MISS < (equal < least + 4).mean()
    assert neardup.least_equal(1.0, neardup.FINE) == neardup.PACK * neardup.FINE
    for threshold in (0.7, 1.1):
        with pytest.raises(ValueError, match="threshold"):
            neardup.near_duplicates(frame(spark), threshold)


def test_edges(spark):
    found = neardup.near_duplicates(frame(spark)).collect()
    by = {r.doc_id: r.class_id for r in found}
    assert len(found) == 16 and by[1] == by[2] == 1 and by[6] == by[7] == 6 and by[3] == by[4] == 3 and by[5] == 5
    assert by[8] != by[9] and by[10] == by[11] == 10
    kept = neardup.keep_one(frame(spark))
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    assert kept.columns == frame(spark).columns and ids.count(2) == 0 and ids.count(1) == 1 and 4 not in ids
    assert neardup.near_duplicates(frame(spark, [])).count() == 0 == neardup.keep_one(frame(spark, [])).count()
    twice = [row(1, "the very same row of words"), row(1, "the very same row of words"), row(None, "x"), row(None, "x")]
    assert neardup.keep_one(frame(spark, twice)).count() == 2


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in list(parent) if find(x) != x}
    found = graph.components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in found.collect()} == want
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
