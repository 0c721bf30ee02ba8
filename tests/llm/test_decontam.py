import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import frame, row, sentences
from chainlake.llm import decontam


def brute_tiles(doc, item, k):
    """Greedy string tiling by its definition: the longest matches of free words first, in order of position."""
    d_free, i_free, total = [x > 0 for x in doc], [True] * len(item), 0
    while True:
        best, found = k, []
        for t in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while t + n < len(doc) and p + n < len(item) and doc[t + n] == item[p + n] and d_free[t + n] and i_free[p + n]:
                    n += 1
                if n > best:
                    best, found = n, [(t, p)]
                elif n == best and n >= k:
                    found.append((t, p))
        if not found:
            return total
        for t, p in found:
            if all(d_free[t : t + best]) and all(i_free[p : p + best]):
                d_free[t : t + best] = i_free[p : p + best] = [False] * best
                total += best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(1, 4), min_size=3, max_size=25))
def test_tiles_cover_what_the_definition_covers(doc, item):
    tiles = decontam.tile(doc, item, 3)
    used_d, used_i = [], []
    for t, p, n in tiles:
        assert n >= 3 and doc[t : t + n] == item[p : p + n]
        used_d += range(t, t + n)
        used_i += range(p, p + n)
    assert len(set(used_d)) == len(used_d) and len(set(used_i)) == len(used_i)
    # running searches take lengths in halving steps, so ties may fall differently; no free match may be left
    d = [0 if i in set(used_d) else x for i, x in enumerate(doc)]
    left = [x if j not in set(used_i) else -1 for j, x in enumerate(item)]
    assert brute_tiles(d, left, 3) == 0


def brute_matches(doc, item, s, d_free, i_free):
    """Maximal matches of s free windows, by looking at every pair of places."""
    same = lambda t, p: t >= 0 and p >= 0 and t + s <= len(doc) and p + s <= len(item) and doc[t : t + s] == item[p : p + s] and d_free[t] and i_free[p]
    found = set()
    for t in range(len(doc) - s + 1):
        for p in range(len(item) - s + 1):
            if same(t, p) and not same(t - 1, p - 1):
                n = 0
                while same(t + n, p + n):
                    n += 1
                found.add((n + s - 1, t, p))
    return found


@pytest.mark.parametrize("places", [0, 1 << 20])
@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=3, max_size=30), st.lists(st.integers(1, 3), min_size=3, max_size=20), st.data())
def test_matches_are_the_maximal_ones(places, doc, item, data):
    """By sorting all pairs of places, and word by word of the item, which texts with too many pairs get."""
    s = 3
    d_free = np.array(data.draw(st.lists(st.booleans(), min_size=len(doc) - s + 1, max_size=len(doc) - s + 1)), bool)
    i_free = np.array(data.draw(st.lists(st.booleans(), min_size=len(item) - s + 1, max_size=len(item) - s + 1)), bool)
    before, decontam.PLACES = decontam.PLACES, places
    try:
        found = decontam.matches(decontam.rolling(np.array(doc), s), decontam.rolling(np.array(item), s), s, d_free, i_free)
    finally:
        decontam.PLACES = before
    assert sorted(map(tuple, found.tolist())) == sorted(brute_matches(doc, item, s, d_free, i_free))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=4, max_size=14), min_size=1, max_size=4), st.lists(st.sampled_from("abcd"), max_size=60))
def test_found_items_are_the_covered_ones(items, doc):
    """What the index lists is every item that greedy string tiling of the whole text covers to the threshold."""
    index = decontam.Index([(i, " ".join(x)) for i, x in enumerate(items)])
    found = {m[0]: m[2] for m in index.matches(" ".join(doc))}
    ids = [index.vocabulary.get(w, 0) for w in doc]
    want = {i: sum(n for *_, n in decontam.tile(ids, item)) for i, item, _ in index.items}
    assert found == {i: n for i, n in want.items() if n >= decontam.THRESHOLD * len(items[i])}


def test_one_word_repeated_takes_no_time(spark):
    bench = spark.createDataFrame([(1, "word " * 1000), (2, "word " * 120), (3, "a b " * 300)], "item_id long, text string")
    began = time.time()
    found = decontam.contamination(frame(spark, [row(1, "word " * 20000), row(2, "b a " * 10000), row(3, " " * 10**6), row(4, "x" * 10**6)]), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in found) == [(1, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0)] and time.time() - began < 30


def test_one_block_is_held_at_a_time(spark, monkeypatch):
    """Of a benchmark of several blocks, each one's matches are written before the next is fetched."""
    log, save, scan = [], decontam.saved, decontam._scan
    monkeypatch.setattr(decontam, "saved", lambda df, tag: log.append("written") or save(df, tag))
    monkeypatch.setattr(decontam, "_scan", lambda *a: log.append("fetched") or scan(*a))
    bench = spark.createDataFrame([(i, f"the item number {i} has these words of its own x{i}") for i in range(40)], "item_id long, text string")
    docs = frame(spark, [row(i, f"before the item number {i} has these words of its own x{i} after") for i in range(40)])
    found = decontam.contamination(docs, bench, block_chars=600, threshold=1).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(40)} and log[:4] == ["fetched", "written"] * 2 and len(log) > 4
    assert decontam.keep_clean(docs, bench, block_chars=600).count() == 0


def test_planted(spark):
    rng = random.Random(5)
    items = [" ".join(sentences(rng, 5)) for _ in range(6)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(10, None), (11, ""), (None, items[0]), (12, "a b")], "item_id long, text string")
    parts = items[1].split(". ")
    rng.shuffle(parts)
    clean = " ".join(sentences(rng, 30))
    rows = [
        row(1, f"{clean} {items[0].upper()} {clean}"), row(2, clean), row(3, clean + " " + ". ".join(parts)), row(4, items[2][: len(items[2]) // 4] + clean),
        row(5, None), row(6, ""), row(None, items[3]), row(7, items[4]), row(7, items[4]), row(8, "a b c d"),
    ]
    for chars in (decontam.BLOCK_CHARS, 500):  # one block, and several
        found = decontam.contamination(frame(spark, rows), bench, block_chars=chars).collect()
        assert sorted((r.doc_id or 0, r.item_id if r.item_id is not None else -1) for r in found) == [(0, 3), (1, -1), (1, 0), (3, 1), (7, 4), (7, 4)]
        assert all(0.6 <= r.coverage <= 1 for r in found) and next(r for r in found if r.doc_id == 3).tiles > 1
    kept = decontam.keep_clean(frame(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 8] and kept.columns == frame(spark, rows).columns


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(frame(spark), none).count() == 0
    assert decontam.keep_clean(frame(spark), none).count() == 16
    assert decontam.contamination(frame(spark, []), spark.createDataFrame([(1, "some words to find here")], "item_id long, text string")).count() == 0
