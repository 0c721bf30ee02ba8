import random
import re
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import frame, row, sentences
from chainlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(doc_id, text):
    words, text = WORD.findall(text or ""), text or ""
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


def test_counts_are_the_brute_ones(spark):
    texts = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    found = quality.assess(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert {tuple(r)[:7] for r in found} == {brute(*t) for t in texts}
    assert not any(r.kept and r.base_failed for r in found)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab #\n\t\x0b\x0c\r\xa0é|.", max_size=60), min_size=1, max_size=30))
def test_counts_of_odd_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = quality.counts(docs).collect()
    assert {tuple(r)[:6] for r in found} == {brute(i, t)[:6] for i, t in enumerate(texts)}


def test_counts_under_collisions(spark):
    """Windows whose 38 hash bits are equal though their words are not, sorted between those that repeat; and any other number of bits."""
    text = "a174210 b174210 c174210 p a379122 b379122 c379122 q a174210 b174210 c174210"
    rng = random.Random(3)
    rows = [(1, text)] + [(i, " ".join(rng.choice(["x", "y", "z"]) for _ in range(300))) for i in range(2, 6)]
    found = quality.counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r)[:6] for r in found} == {brute(i, t)[:6] for i, t in rows}


def test_counts_where_all_windows_collide(spark, monkeypatch):
    """With no hash bits but the lowest few, equal windows are still told apart by their words."""
    monkeypatch.setattr(quality.F, "xxhash64", lambda *cs: (F.length(cs[0]) % 2).cast("long"))
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["x", "yy", "z", "ww"]) for _ in range(120))) for i in range(6)] + [(9, "a b c d")]
    found = quality.counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r)[:6] for r in found} == {brute(i, t)[:6] for i, t in rows}


def brute_em(votes, names, steps):
    good, right = quality.GOOD, {k: (quality.START_GOOD, quality.START_BAD) for k in names}

    def posterior(v):
        a, b = good, 1 - good
        for k in names:
            if v[k] is not None:
                a *= right[k][0] if v[k] else 1 - right[k][0]
                b *= 1 - right[k][1] if v[k] else right[k][1]
        return a / (a + b)

    low = 1 - quality.MOST_RIGHT
    clip = lambda x, least: min(quality.MOST_RIGHT, max(least, x))
    for _ in range(steps):
        p = [posterior(v) for v in votes]
        new = {}
        for k in names:
            g = sum(x for x, v in zip(p, votes, strict=True) if v[k] is not None)
            g1 = sum(x for x, v in zip(p, votes, strict=True) if v[k] == 1)
            b = sum(1 - x for x, v in zip(p, votes, strict=True) if v[k] is not None)
            b0 = sum(1 - x for x, v in zip(p, votes, strict=True) if v[k] == 0)
            a = clip((g1 + quality.START_GOOD) / (g + 1), low)
            new[k] = (a, clip((b0 + quality.START_BAD) / (b + 1), max(low, 1 - a + quality.APART)))
        good, right = clip(sum(p) / len(p), low), new
    return [posterior(v) for v in votes]


def test_em_is_the_brute_one(spark):
    rng, names = random.Random(2), ["a", "b", "c"]
    votes = [{k: rng.choice([1, 1, 1, 1, 0, None]) for k in names} for _ in range(300)]
    table = spark.createDataFrame([tuple(v[k] for k in names) for v in votes], "a int, b int, c int")
    estimates = quality.fit(table, names, steps=6)
    found = [r[0] for r in table.select(estimates.posterior()).collect()]
    want = brute_em(votes, names, 6)
    assert max(abs(x - y) for x, y in zip(sorted(found), sorted(want), strict=True)) < 1e-6


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(1)
    rows = [row(i, "\n".join(sentences(rng, 8 + i % 5))) for i in range(80)]
    rows += [row(100 + i, " ".join(w + "###" for s in sentences(rng, 9) for w in s.split())) for i in range(5)]
    rows += [row(200 + i, " ".join(w.upper() + "!!" for s in sentences(rng, 9) for w in s.split())) for i in range(5)]
    kept = {r.doc_id: r.kept for r in quality.assess(frame(spark, rows)).collect()}
    assert all(kept[i] for i in range(80)) and not any(kept[i] for i in kept if i >= 100)


def test_the_verdict_is_not_all_must_pass(spark):
    """Against labels that nothing was learned from: rules that each must be passed lose many good documents, the posterior none, and neither
    keeps a bad one."""
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = quality.rules()
    strict = quality.counts(docs).withColumns(rules).select("doc_id", *rules).collect()
    passes = {r.doc_id: not any(r[k] == 0 for k in rules) for r in strict}
    found = [r for r in quality.assess(docs).collect() if not r.base_failed and r.doc_id in labels]
    good, bad = [r for r in found if labels[r.doc_id]], [r for r in found if not labels[r.doc_id]]
    assert len(good) > 200 and len(bad) > 15
    assert all(r.kept for r in good) and not any(r.kept for r in bad)
    assert sum(not passes[r.doc_id] for r in good) >= 0.05 * len(good)


def test_edges(spark):
    found = quality.assess(frame(spark)).collect()
    assert len(found) == 16 and all(r.base_failed and not r.kept and r.n_words == 0 for r in found if r.doc_id in (3, 4, 5))
    assert quality.assess(frame(spark, [])).count() == 0
    assert [f.dataType.typeName() for f in quality.assess(frame(spark)).schema][:8] == ["long"] * 6 + ["boolean"] * 2


def test_native_plan(spark):
    assert not re.search("Python|Pandas|Arrow", quality.counts(frame(spark))._jdf.queryExecution().executedPlan().toString())
