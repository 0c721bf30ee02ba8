import random
from collections import Counter
from itertools import combinations

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import frame, row, sentences
from chainlake.llm import license


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=9, unique_by=(lambda p: p[0], lambda p: p[1])))
def test_longest_increasing(pairs):
    pairs = sorted(pairs)
    found = license.increasing(pairs)
    rising = lambda ps: all(a[1] < b[1] for a, b in zip(ps, ps[1:], strict=False))
    best = max((n for n in range(len(pairs) + 1) if any(rising(c) for c in combinations(pairs, n))), default=0)
    assert rising(found) and len(found) == best and set(found) <= set(pairs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=20), st.lists(st.sampled_from("abcdefgh"), max_size=20))
def test_alignment_is_one(a, b):
    pairs = license.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    if a == b:
        assert len(pairs) == len(a)


def test_gaps_are_aligned_again():
    a, b = "x the one the y the z".split(), "x the two the y the z".split()
    assert len(license.align(a, b)) == 6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcdx"), max_size=30), st.lists(st.sampled_from("abcd"), min_size=1, max_size=6))
def test_stretches_miss_nothing(ws, template):
    at, most, need, own = [i for i, w in enumerate(ws) if w in template], 2 * len(template), 0.8 * len(template), Counter(template)
    starts = {lo for run in license.stretches(ws, at, own, most, need) for _, lo, _ in run}
    assert starts == {lo for lo in at if sum((Counter(ws[lo : lo + most]) & own).values()) >= need}


def test_small_table(spark):
    texts = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    want = {(d, name) for d, t in texts for name, (_, notice) in license.TEMPLATES.items() if " ".join(license.words(notice)) in " ".join(license.words(t))}
    assert {(r.doc_id, r.template) for r in license.query(spark, "/root/testdata/sf0.001").collect()} >= want and want


def test_planted(spark):
    rng = random.Random(6)
    text = license.TEMPLATES["MIT"][1]
    changed = text.split()
    changed[3:5], changed[20:20], changed[40:43] = ["CHARGED"], ["really", "very"], []
    prose = "\n".join(sentences(rng, 40))
    rows = [row(1, f"{prose}\n{text}\n{prose}"), row(2, f"{prose} {' '.join(changed)} {prose}"), row(3, " ".join(sorted(text.split()))), row(4, text[: len(text) // 2]), row(5, text + text + license.TEMPLATES["ISC"][1]),
            row(None, "Released under the MIT license."), row(6, "the software of the and to " * 2000), *[row(7, None), row(7, None), row(8, "")]]
    found = license.licenses(frame(spark, rows)).collect()
    assert {(r.doc_id, r.template) for r in found} == {(1, "MIT"), (2, "MIT"), (5, "MIT"), (5, "ISC"), (None, "MIT-notice")}
    one = next(r for r in found if r.doc_id == 1)
    assert one.coverage == 1 and license.words(rows[0][1])[one.first_word : one.last_word + 1] == license.words(text)
    assert next(r for r in found if r.doc_id == 2).coverage < 1
    assert license.licenses(frame(spark, [])).count() == 0 and license.licenses(frame(spark)).count() == 0


def brute_covered(text, template, least=license.LEAST):
    """Whether some stretch of the text holds the template's words in order, as the longest common subsequence has it."""
    a, b = license.words(text), license.words(template)
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1] >= least * len(b)


def test_foreign_words_do_not_hide_a_license(spark):
    """Whatever stands between a license text's words, at every distance, and however often the text comes."""
    rng = random.Random(8)
    text = license.TEMPLATES["MIT"][1].split()
    spread = lambda k: " ".join(" ".join([w, *(f"foreign{rng.randrange(10**6)}" for _ in range(k))]) for w in text)
    prose = " ".join(sentences(rng, 200))
    rows = [row(k, spread(k)) for k in (0, 1, 2, 3, 10, 60)] + [row(100, f"{prose} {spread(2)} {prose}"), row(101, f"{spread(2)} {spread(2)} {prose} {spread(4)}"), row(102, prose)]
    found = license.licenses(frame(spark, rows)).collect()
    assert {(r.doc_id, r.template, r.coverage) for r in found} == {(k, "MIT", 1.0) for k in (0, 1, 2, 3, 10, 60, 100, 101)}


def test_found_is_what_the_longest_common_subsequence_covers():
    """Changed license texts among others' words: every one that is covered is found, and none that is not."""
    rng, scanner, both = random.Random(9), license.Scanner(), [0, 0]
    names = [n for n, (_, t) in license.TEMPLATES.items() if len(license.words(t)) > license.PHRASE]
    for _ in range(60):
        name = rng.choice(names)
        words = license.words(license.TEMPLATES[name][1])
        changed = [w for w in words if rng.random() > 0.3 * rng.random()]
        for _ in range(rng.randrange(40)):
            changed.insert(rng.randrange(len(changed) + 1), f"foreign{rng.randrange(100)}")
        text = " ".join(changed)
        want = brute_covered(text, license.TEMPLATES[name][1])
        spdx = {r[1] for r in scanner.scan(text)}
        found = license.TEMPLATES[name][0] in spdx
        both[want] += 1
        assert found or not want or scanner.scan(text)[0][3] >= 0.8 * len(words), (name, text)
        assert want or not any(r[0] == name for r in scanner.scan(text))
    assert min(both) > 3


def test_the_longer_of_two_that_cover_a_stretch_is_reported():
    scan = license.Scanner().scan
    for name, (spdx, text) in license.TEMPLATES.items():
        assert {r[1] for r in scan(f"Some words before it. {text} And after.")} == {spdx}, name
    two = license.TEMPLATES["MIT-full"][1] + " " + license.TEMPLATES["Apache-2.0-notice"][1]
    assert {r[0] for r in scan(two)} == {"MIT-full", "Apache-2.0-notice"}


def test_long_scrambled_texts_end(spark):
    rng = random.Random(10)
    words = license.TEMPLATES["MIT"][1].split() * 60
    rng.shuffle(words)
    rows = [row(1, " ".join(words)), row(2, " " * 10**6), row(3, "x" * 10**6), row(4, "software " * 10**5)]
    assert license.licenses(frame(spark, rows)).count() <= 1
