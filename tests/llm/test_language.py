import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from cases import frame, row
from chainlake.llm import langid

DOCS = "/root/testdata/sf0.001/documents.parquet"


def brute_counts(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    grams = Counter()
    for w in words:
        p = f" {w} "
        grams.update(w)
        grams.update(p[i : i + 2] for i in range(len(p) - 1))
        grams.update(p[i : i + 3] for i in range(len(p) - 2))
    return grams


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


def brute_rank(counts, k):
    return [c for _, c in sorted((-n, c) for c, n in counts.items())][:k]


@pytest.mark.parametrize("text", ["The cat, the HAT!", "é", "a b", "x1y2z", "Ünïcode  Straße\n\n日本 語", "  "])
def test_grams(text):
    codes, counts = langid.gram_counts(text)
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == {code(g): n for g, n in brute_counts(text).items()}


def test_distance_is_the_brute_one():
    rng = random.Random(3)
    texts = {lang: " ".join("".join(rng.choice(a) for _ in range(rng.randint(1, 6))) for _ in range(300)) for lang, a in {"x": "abcde", "y": "defgh", "z": "ghijk"}.items()}
    k = 40
    model = {lang: brute_rank({code(g): n for g, n in brute_counts(t).items()}, k) for lang, t in texts.items()}
    profiles = langid.Profiles(model, k)
    for t in [*texts.values(), "abc de fgh", "zzz", "a"]:
        own = brute_rank({code(g): n for g, n in brute_counts(t).items()}, k)
        away = {lang: sum(abs(i - p.index(g)) if g in p else k for i, g in enumerate(own)) for lang, p in model.items()}
        best = min(sorted(away), key=away.get)
        lang, score = profiles.predict(t)
        assert lang == best and np.isclose(score, 1 - away[best] / (k * len(own)))


def test_query_is_the_brute_one(spark):
    """Profiles, predictions, scores and folds of the whole query, by counting grams one by one."""
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{DOCS}'").fetchall()
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, *_ in docs}
    grams = {d: Counter({code(g): n for g, n in brute_counts(t or "").items()}) for d, t, _ in docs}
    totals = {}
    for d, t, lang in docs:
        if lang is not None and t is not None and not held[d]:
            totals.setdefault(lang, Counter()).update(grams[d])
    places = {lang: {g: i for i, g in enumerate(brute_rank(c, langid.PROFILE))} for lang, c in totals.items()}
    want = {}
    for d, *_ in docs:
        own = brute_rank(grams[d], langid.PROFILE)
        away = {lang: sum(abs(i - p[g]) if g in p else langid.PROFILE for i, g in enumerate(own)) for lang, p in places.items()}
        best = min(sorted(away), key=away.get) if own else "und"
        want[d] = held[d], best, 1 - away[best] / (langid.PROFILE * len(own)) if own else 0.0
    found = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in langid.query(spark, "/root/testdata/sf0.001").collect()}
    assert found.keys() == want.keys() and all(found[d][:2] == want[d][:2] and np.isclose(found[d][2], want[d][2]) for d in want)


def test_held_out_accuracy(spark):
    found = langid.query(spark, "/root/testdata/sf0.001").toPandas()
    truth = duckdb.sql(f"SELECT doc_id, lang FROM '{DOCS}'").df()
    both = found.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(both) == len(truth) and len(held) > 10 and (held.lang == held.lang_pred).mean() >= 0.95


def test_edges(spark):
    found = [tuple(r) for r in langid.identify(frame(spark)).collect()]
    assert len(found) == 16 and all(0 <= r[3] <= 1 for r in found)
    assert {r[0]: r[2] for r in found if r[0] in (3, 4, 5, 6, 8)} == {3: "und", 4: "und", 5: "und", 6: "und", 8: "en"}
    assert [r[1] for r in found if r[0] is None] == [False, False]
    assert langid.identify(frame(spark, [])).count() == 0
    nothing = langid.identify(frame(spark, [row(1, "words but no label", None)])).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    kept = langid.keep_known(frame(spark))
    assert kept.columns == frame(spark).columns and {r.doc_id for r in kept.collect()} == {1, 2, None, 8, 9, 10, 11, 12, 13}


def test_lang_is_no_input(spark):
    rows = [row(i, f"hello world number {'abcdefghij'[i % 10] * 3}") for i in range(40)]
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
    changed = [row(r[0], r[1], "zz" if r[0] in held else r[2]) for r in rows]
    assert {r.lang_pred for r in langid.identify(frame(spark, changed)).collect()} == {"en"}


def test_only_taught_languages_are_kept(spark):
    """Languages that no label teaches and letter junk go; whole texts and short pieces of the taught languages stay."""
    rng = random.Random(5)
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi. Mọi con người đều được tạo hóa ban cho lý trí.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. the of and",
        *("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n)) for n in (120, 2000)),
        *(" ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 9))) for _ in range(100)) for a in ("bcdfghjklmnpqrstvwxz", "abcdefghijklmnopqrstuvwxyz")),
    ]
    docs = spark.read.parquet(DOCS).select("doc_id", "text", "lang")
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{DOCS}'").fetchall()
    short = [" ".join(t.split()[:n]) for _, t in texts[:40] for n in (10, 25)]
    extra = [(10**6 + i, t, None) for i, t in enumerate(foreign)] + [(2 * 10**6 + i, t, None) for i, t in enumerate(short)]
    kept = {r.doc_id for r in langid.keep_known(docs.unionByName(spark.createDataFrame(extra, docs.schema))).collect()}
    assert kept == {d for d, _ in texts} | {2 * 10**6 + i for i in range(len(short))}
