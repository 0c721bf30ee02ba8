import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import frame, row
from chainlake.llm import packing


def brute_cost(at, penalty, window):
    powers = {p for x in range(window.bit_length()) if packing.LEAST_POWER <= (p := 1 << x) < window}
    cost = [0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            n = at[j] - at[i]
            if n <= window:
                cost[j] = min(cost[j], cost[i] + (0 if n in powers else window - n) + penalty[j])
    return cost[-1]


def cost_of(bounds, at, penalty, window):
    powers = {p for x in range(window.bit_length()) if packing.LEAST_POWER <= (p := 1 << x) < window}
    by = dict(zip(at, penalty, strict=True))
    return sum((0 if b - a in powers else window - (b - a)) + by[b] for a, b in zip(bounds, bounds[1:], strict=False))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 140), st.sampled_from([0, 4, 48])), min_size=1, max_size=60), st.sampled_from([160, 256, 512]))
def test_cuts_are_the_cheapest(steps, window):
    at, penalty = [0, *np.cumsum([n for n, _ in steps]).tolist()], [0, *[p for _, p in steps]]
    bounds = packing.cuts(at, penalty, window)
    assert bounds[0] == 0 and bounds[-1] == at[-1] and all(0 < b - a <= window for a, b in zip(bounds, bounds[1:], strict=False))
    assert cost_of(bounds, at, penalty, window) == brute_cost(at, penalty, window)


def test_places():
    ends = np.zeros(10, bool)
    ends[9] = True
    ids = np.array([1, 9, 1] + [1] * 250 + [0, 9, 0], np.uint32)
    at, penalty = packing.places(ids, np.array([254, 256]), ends)
    assert dict(zip(at.tolist(), penalty.tolist(), strict=True)) == {0: 0, 2: 4, 98: 48, 194: 48, 254: 0, 255: 4, 256: 0}


@pytest.fixture(scope="module")
def encoders():
    from tokenizers import Tokenizer

    paths = packing.default_paths()
    return Tokenizer.from_file(paths[0]), packing.Encoder(*paths)


def test_encoder_gives_the_tokenizers_ids(encoders):
    slow, fast = encoders
    rng = random.Random(1)
    odd = " \n\t\r\x0b\x0c\x1c\x85\xa0  　éßñ'’s't日本۳٣½²_-.!?<|>ab1" + "\u200b\u0301\U0001f600"
    texts = ["", "<|endoftext|>", "a <|endoftext|> b", "it's  I'LL 'd"] + ["".join(rng.choice(odd) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    for t in texts:
        assert fast(t).tolist() == slow.encode(t, add_special_tokens=False).ids + [0], repr(t)


def check(rows, ids):
    by, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    for doc_id, pieces in by.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[doc_id])
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[doc_id][r.start : at], "<u4").tobytes())
        assert at == len(ids[doc_id])
    assert set(by) == set(ids)
    padding = tokens = 0
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= packing.WINDOW
        tokens += at
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padding / tokens


def test_round_trip_with_little_padding(spark):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.default_paths()[0])
    texts = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    ids = {d: slow.encode(t, add_special_tokens=False).ids + [0] for d, t in texts}
    rows = packing.query(spark, "/root/testdata/sf0.001").collect()
    assert check(rows, ids) < 0.03
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))]
    assert order == sorted(order)


def test_blocks_carry_over():
    rng = np.random.default_rng(3)
    ends = rng.random(1000) < 0.1
    packer = packing.Packer(ends, 0, block=5000)
    docs = [np.append(rng.integers(1, 1000, n), 0).astype(np.uint32) for n in [5, 0, 20000, *rng.integers(1, 900, 200)]]
    rows = [r for i, d in enumerate(docs) for r in packer.add(i, d)] + packer.flush(True)

    class Row:
        def __init__(self, values):
            self.__dict__ |= dict(zip([x.split()[0] for x in packing.SCHEMA.split(", ")], values, strict=True))

    assert check([Row(r) for r in rows], {i: d.tolist() for i, d in enumerate(docs)}) < 0.03
    assert packing.Packer(ends, 0).flush(True) == []


def test_edges(spark):
    rows = packing.pack(frame(spark)).collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows if r.doc_id in (3, 4)} == {3: (1, zlib.crc32(bytes(4))), 4: (1, zlib.crc32(bytes(4)))}
    assert sum(r.start == 0 for r in rows) == 16
    assert packing.pack(frame(spark, [])).count() == 0
    assert packing.pack(frame(spark, [row(1, "word " * 30000)])).agg({"length": "sum"}).first()[0] > 30000


@pytest.mark.parametrize("text", [" " * 10**6, "\n" * 10**6, "\t " * 500_000, "\u3000" * 300_000, "a" * 10**6, "1" * 10**6, "!" * 10**6, "word " * 200_000, " " * 3000 + "x" + "\n" * 2000 + " y\u00a0" + "\t" * 1500])
def test_long_runs_of_one_class(encoders, text):
    slow, fast = encoders
    assert fast(text).tolist() == [*slow.encode(text, add_special_tokens=False).ids, 0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([" ", "\n", "\t", "\u3000", "x", "é", "7", "'s", "!", "\x1c"]), st.integers(1, 6)), max_size=8))
def test_runs_are_cut_where_the_pattern_cuts(encoders, parts):
    """As above with runs of three instead of a thousand."""
    slow, fast = encoders
    text = "".join(c * n for c, n in parts)
    before, packing._long_space = packing._long_space, packing._runs_of(3)
    try:
        found = fast(text).tolist()
    finally:
        packing._long_space = before
    assert found == [*slow.encode(text, add_special_tokens=False).ids, 0]


def test_long_runs_through_spark(spark):
    found = packing.pack(frame(spark, [row(1, " " * 10**6), row(2, "\n" * 10**6), row(3, "<|endoftext|>" + " " * 10**6)])).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(found) == 3 and all(r["sum(length)"] == r["max(doc_tokens)"] > 10**5 for r in found)
