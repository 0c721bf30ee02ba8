"""Benchmark decontamination by greedy string tiling.

A document and a test item become a pair if they share a seed: a run of `min_match` words. On each pair, running
Karp-Rabin greedy string tiling marks the longest matches between unmarked words first, none overlapping another, down to
`min_match` words; so a passage whose parts were put in another order still is covered. An item whose words are covered to
`threshold` or more contaminates the document.

The benchmark is the query set. It goes to every task in blocks of about `block_chars` characters, one at a time; a larger one takes
one pass over the documents for each block. Documents never leave their task, and only matches are returned, so neither a
hot passage nor a hot source makes a large task.

Defined cases: null and empty texts match nothing; an item of fewer than `min_match` words matches nothing; equal items are
separate matches; of matches of equal length the one earlier in the document, then in the item, is marked first; repeated rows are reported
as often as they occur; a null id is reported as null; an empty benchmark or table gives no rows; other columns are ignored. Words are runs of \\w, in lower case; whole texts are used.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import read, saved, slices

MIN_MATCH = 4
THRESHOLD = 0.6
BLOCK_CHARS = 8_000_000
#: Pairs of places of equal windows that tiling holds at once.
PLACES = 1 << 20
SCHEMA = "doc_id long, item_id long, coverage double, matched_words long, item_words long, tiles long, longest_tile long"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_words = re.compile(r"\w+").findall


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin value of every run of k ids, modulo 2**64."""
    out = np.zeros(max(0, len(ids) - k + 1), np.uint64)
    for j in range(k):
        out = out * _BASE + ids[j : j + len(out)].astype(np.uint64)
    return out


def _runs(t: np.ndarray, p: np.ndarray, s: int) -> np.ndarray:
    """Maximal matches (length, start in doc, start in item) from the places of equal windows of s words, ascending by diagonal and place."""
    first = np.flatnonzero(np.concatenate([[True], (np.diff(t) != 1) | (np.diff(p) != 1)]))
    return np.stack([np.diff(np.append(first, len(t))) + s - 1, t[first], p[first]], axis=1)


def matches(d_hash: np.ndarray, i_hash: np.ndarray, s: int, d_free: np.ndarray, i_free: np.ndarray) -> np.ndarray:
    """The maximal matches of s free words or more by equal hashes, as rows (length, start in doc, start in item). Places that match are found by
    sorting; the item is taken in parts, so that no more than PLACES pairs of places are held beside a part of one word."""
    t, p = np.flatnonzero(d_free), np.flatnonzero(i_free)
    p = p[np.argsort(i_hash[p], kind="stable")]
    keys = i_hash[p]
    low, high = np.searchsorted(keys, d_hash[t]), np.searchsorted(keys, d_hash[t], "right")
    hit = high > low
    t, low, n = t[hit], low[hit], (high - low)[hit]
    if not len(t):
        return np.empty((0, 3), np.int64)
    if n.sum() <= PLACES:
        at = np.repeat(t, n)
        to = p[np.repeat(low, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
        order = np.lexsort((at, at - to))
        return _runs(at[order], to[order], s)
    # many pairs, as in texts of one repeated word: word by word of the item, with the lengths of the matches that start one word later
    out, later = [], np.zeros(len(d_hash) + 1, np.int64)
    for q in range(len(i_hash) - 1, -2, -1):
        own = d_free & (d_hash == i_hash[q]) if q >= 0 and i_free[q] else np.zeros(len(d_hash), bool)
        starts = np.flatnonzero((later[:-1] > 0) & ~np.concatenate([[False], own[:-1]]))  # a match from word q + 1 on, which word q does not prolong
        out.append(np.stack([later[starts] + s - 1, starts, np.full(len(starts), q + 1)], axis=1))
        later = np.append(np.where(own, 1 + later[1:], 0), 0)
    return np.concatenate(out)


def _checked(found: np.ndarray, doc: np.ndarray, item: np.ndarray, s: int) -> list[tuple[int, int, int]]:
    """The matches whose words are equal too, the longest first. What two hashes alone made equal is cut out of a match."""
    out = []
    for n, t, p in found[np.lexsort((found[:, 2], found[:, 1], -found[:, 0]))].tolist():
        unequal = np.flatnonzero(doc[t : t + n] != item[p : p + n])
        if len(unequal):
            for a, b in zip(np.append(-1, unequal) + 1, np.append(unequal, n), strict=True):
                if b - a >= s:
                    out.append((int(b - a), int(t + a), int(p + a)))
        else:
            out.append((n, t, p))
    return sorted(out, key=lambda x: (-x[0], x[1], x[2]))


def tile(doc: list[int] | np.ndarray, item: list[int], min_match: int = MIN_MATCH, start: int = 20) -> list[tuple[int, int, int]]:
    """Tiles (start in doc, start in item, length) of running Karp-Rabin greedy string tiling. Ids of 0 match nothing."""
    d_ids, i_ids, tiles = np.array(doc, np.int64), np.array(item, np.int64), []
    d_free, i_free = d_ids > 0, i_ids > 0
    s = max(min_match, min(start, len(item)))
    while True:
        whole = lambda mark: np.convolve(mark, np.ones(s, np.int64), "valid") == s if len(mark) >= s else np.zeros(0, bool)
        found = _checked(matches(rolling(d_ids, s), rolling(i_ids, s), s, whole(d_free), whole(i_free)), d_ids, i_ids, s)
        if found and found[0][0] > 2 * s:
            s = found[0][0]
            continue
        again = False
        for n, t, p in found:
            if d_free[t : t + n].all() and i_free[p : p + n].all():
                d_free[t : t + n] = i_free[p : p + n] = False
                tiles.append((t, p, n))
            else:  # what an earlier tile left of it may still be a match of this length
                again = True
        if again:
            continue
        if s <= min_match:
            return tiles
        s = max(min_match, s // 2)


class Index:
    """The benchmark's vocabulary, its items as word ids, and the sorted Karp-Rabin values of its seeds, each item's once, with how often it has them."""

    def __init__(self, items: list[tuple[int, str]], min_match: int = MIN_MATCH):
        self.k, self.vocabulary, self.items = min_match, {}, []
        found = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in _words((text or "").lower())]
            if len(ids) >= min_match:
                h, n = np.unique(rolling(np.array(ids, np.int64), min_match), return_counts=True)
                found.append((h, n, np.full(len(h), len(self.items), np.int64)))
                self.items.append((item_id, ids, h))
        self.hashes, self.counts, self.owners = (np.concatenate([f[i] for f in found]) if found else np.empty(0, t) for i, t in enumerate((np.uint64, np.int64, np.int64)))
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.counts, self.owners = self.hashes[order], self.counts[order], self.owners[order]

    def matches(self, text: str | None, threshold: float = THRESHOLD) -> list[tuple]:
        """(item_id, coverage, matched words, item words, tiles, longest tile) of each item that contaminates the text."""
        k, get, out = self.k, self.vocabulary.get, []
        if not text or not self.items:
            return out
        ids = np.array([get(w, 0) for w in _words(text.lower())], np.int64)
        if len(ids) < k:
            return out
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        at = np.flatnonzero(known[k:] - known[:-k] == k)
        if not len(at):
            return out
        h = rolling(ids, k)[at]
        own = np.unique(h)
        low, high = np.searchsorted(self.hashes, own), np.searchsorted(self.hashes, own, "right")
        n = high - low
        place = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owners, which = np.unique(self.owners[place], return_inverse=True)
        seeds = np.bincount(which, self.counts[place], len(owners))
        for owner, hits in zip(owners.tolist(), seeds.tolist(), strict=True):
            item_id, item, hashes = self.items[owner]
            if k * hits < threshold * len(item):  # a tile has a seed for k of its words at least
                continue
            pos = at[np.isin(h, hashes)]
            covered = np.bincount(pos, minlength=len(ids) + 1) - np.bincount(pos + k, minlength=len(ids) + 1)
            inside = np.cumsum(covered)[:-1] > 0  # the words of all seeds, each run closed by a 0
            inside_or_after = inside | np.concatenate([[False], inside[:-1]])
            tiles = tile(np.where(inside, ids, 0)[inside_or_after], item, k)
            matched = sum(n for _, _, n in tiles)
            if matched >= threshold * len(item):
                out.append((item_id, matched / len(item), matched, len(item), len(tiles), max(n for _, _, n in tiles)))
        return out


def _blocks(benchmark: DataFrame, block_chars: int) -> tuple[int, Callable[[int], list[tuple[int, str]]]]:
    """How many blocks the benchmark has, and a function that fetches one of them."""
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    chars = bench.agg(F.sum(F.length("text") + 16)).first()[0]
    n = -(-int(chars or 0) // block_chars)

    def block(i: int) -> list[tuple[int, str]]:
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else bench
        return [(r.item_id, r.text) for r in part.collect()]

    return n, block


def contamination(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and each item that contaminates it. Of several blocks each one's rows are written before the next is fetched, so
    that the driver and the tasks hold one at a time."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    out = documents.sparkSession.createDataFrame([], SCHEMA)
    n, block = _blocks(benchmark, block_chars)
    for i in range(n):
        found = docs.mapInArrow(_scan(block(i), threshold, min_match), SCHEMA)
        out = out.unionByName(saved(found, "matches") if n > 1 else found)
    return out


def _scan(items: list[tuple[int, str]], threshold: float, min_match: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, min_match)
        for b in slices(batches):
            rows = [(d, *m) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in index.matches(t, threshold)]
            if rows:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")]).astype({"doc_id": "Int64", "item_id": "Int64"}), preserve_index=False)

    return scan


def _is_dirty(items: list[tuple[int, str]], threshold: float, min_match: int):
    made: list[Index] = []

    def dirty(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(Index(items, min_match))
        return pd.Series([bool(made[0].matches(t, threshold)) for t in texts], dtype=bool)

    return F.pandas_udf(dirty, "boolean").asNondeterministic()


def keep_clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows that no item contaminates, all columns kept. What a block leaves is written before the next one is fetched."""
    n, block = _blocks(benchmark, block_chars)
    for i in range(n):
        documents = documents.where(~_is_dirty(block(i), threshold, min_match)("text"))
        if i < n - 1:
            documents = saved(documents, "clean")
    return documents


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
