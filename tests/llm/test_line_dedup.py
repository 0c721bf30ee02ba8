import random
from collections import defaultdict

import duckdb
import pytest

from cases import frame, row, sentences
from chainlake.llm import linedup


def clean(text):
    return [x for x in (line.strip(" \t\r\f\v") for line in (text or "").split("\n")) if x]


def brute(texts, min_words=linedup.MIN_WORDS):
    """Kept lines by document: of every suffix the longest run that starts at an earlier suffix too is a copy, if it has the words."""
    where, lines, out = defaultdict(list), {}, {}
    for key, text in texts:
        own = lines[key] = clean(text)
        gone = set()
        for s, first in enumerate(own):
            longest = 0
            for other, t in where[first]:
                n = 0
                while s + n < len(own) and t + n < len(lines[other]) and own[s + n] == lines[other][t + n]:
                    n += 1
                longest = max(longest, n)
            if sum(len(x.split()) for x in own[s : s + longest]) >= min_words:
                gone |= set(range(s, s + longest))
            where[first].append((key, s))
        out[key] = [x for i, x in enumerate(own) if i not in gone]
    return out


def test_small_table(spark):
    texts = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY 1").fetchall()
    found = {r.doc_id: clean(r.text) for r in linedup.query(spark, "/root/testdata/sf0.001").collect()}
    assert found == brute(texts)


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, seed):
    rng = random.Random(seed)
    pool = ["a b", "c", "d e f", "g g g g", "h i", "  c ", ""]
    rows = [row(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    found = {r.doc_id: clean(r.text) for r in linedup.dedup_lines(frame(spark, rows), min_words=12).collect()}
    assert found == brute([(r[0], r[1]) for r in rows], 12)


def test_hot_passage(spark):
    rng = random.Random(9)
    passage = "\n".join(sentences(rng, 6))
    rows = [row(i, "\n".join([*sentences(rng, 2), passage, *sentences(rng, 2)])) for i in range(60)]
    found = linedup.dedup_lines(frame(spark, rows)).collect()
    assert sum(passage in r.text for r in found) == 1 and sum(r[-1] for r in found) == 6 * 59
    assert next(r.doc_id for r in found if passage in r.text) == 0


def test_edges(spark):
    out = linedup.dedup_lines(frame(spark))
    assert out.columns == [*frame(spark).columns, "deleted_"]  # the frame's own column of that name stays
    found = out.collect()
    assert len(found) == 16 and {r.deleted for r in found} == {"clash"}
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append((r.text, r.deleted_))
    assert by[3] == [(None, 0)] and by[4] == [("", 0)] and by[1][0][1] == 0 and by[2] == [("", 12)] * 2
    assert by[11] == [(" ".join([frame(spark).where("doc_id = 11").first().text.split("\n")[-1]]), 899)]
    assert linedup.dedup_lines(frame(spark, [])).count() == 0
