"""License scans by patience alignment.

Words that occur once in the text and once in a template are anchors. The longest increasing subsequence of their
positions is aligned; the gap before, between and after the aligned words is aligned in the same way, where words are unique again, after equal
words at its two ends are matched. Coverage is the share of the template's words that are aligned within the best stretch of the text.

Texts stay in their tasks. The templates are a fixed list of a few thousand words, sent with the code. Only texts that have enough of a
template's words, counted as often as both have them, are aligned with it. Words that the template lacks can't be aligned, so they are left out first,
and a license text is found however many foreign words stand between its own. What is aligned are stretches of the words left: of twice
the template's length from every place, so that copies in a row part, and then of doubling length, each half overlapping the last, up to the whole text. A
notice of at most PHRASE words is a phrase, whose few words would be found scattered over many a long text: it lies within STRETCH times its length.

Defined cases: null and empty texts have no license; a text with several licenses has a row for each; what lies within the stretch of a
template of more matched words, at most STRETCH times its length, is not reported beside it, of equally many the one with the higher coverage, then the first by name, stays; of several
stretches of one template the fullest is reported, then the shortest, then the first; repeated rows and null ids are reported as often as they occur;
an empty table gives no rows; texts are scanned whole, however long; other columns are ignored. Words are runs of letters, digits, "." and "-"
within, in lower case.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import read, slices
from chainlake.llm.license_texts import TEMPLATES

LEAST = 0.8
#: Templates of so few words are phrases, and how many words of text for each of theirs they may stretch over.
PHRASE, STRETCH = 20, 2
SCHEMA = "doc_id long, template string, license string, coverage double, matched_words long, template_words long, first_word long, last_word long"
_words = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*").findall


def words(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs (ascending in the first) that ascends in the second: patience sorting."""
    tops, at, back = [], [], [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        tops[pile : pile + 1], at[pile : pile + 1] = [y], [i]
        back[i] = at[pile - 1] if pile else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, ascending in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = increasing([(i, at_b[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in at_b])
        if not anchors:
            continue
        out += anchors
        for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            if i2 > i + 1 and j2 > j + 1:
                todo.append((i + 1, i2, j + 1, j2))
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, str]] = TEMPLATES, least: float = LEAST):
        self.least = least
        self.templates = [(name, spdx, ws := words(text), Counter(ws)) for name, (spdx, text) in templates.items()]
        self.vocabulary = {w for *_, own in self.templates for w in own}

    def scan(self, text: str | None) -> list[tuple]:
        """(template, license, coverage, matched, template words, first and last word) for each template that the text covers."""
        ws = words(text)
        known = [i for i, w in enumerate(ws) if w in self.vocabulary]
        have, found = Counter(ws[i] for i in known), []
        for name, spdx, template, own in self.templates:
            need = self.least * len(template)
            if sum(min(n, have[w]) for w, n in own.items()) >= need and (best := self._best(ws, [i for i in known if ws[i] in own], template, own, need)):
                n, first, last = best
                found.append((name, spdx, n / len(template), n, len(template), first, last))
        found.sort(key=lambda f: (-f[3], -f[2], f[0]))
        kept: list[tuple] = []
        for f in found:
            if not any(k[5] <= f[5] and f[6] <= k[6] < k[5] + STRETCH * k[4] for k in kept):
                kept.append(f)
        return kept

    def _best(self, ws: list[str], at: list[int], template: list[str], own: Counter, need: float) -> tuple[int, int, int] | None:
        """The most words aligned within a stretch, and the first and last of them."""
        most, best = len(template) * STRETCH, None

        def tried(run: list[str], place: list[int] | range) -> bool:
            nonlocal best
            pairs = align(run, template)
            if len(pairs) >= need:
                new = len(pairs), place[pairs[0][0]], place[pairs[-1][0]]
                if best is None or (-new[0], new[2] - new[1], new[1]) < (-best[0], best[2] - best[1], best[1]):
                    best = new
            return len(pairs) >= need

        def from_every_place(run: list[str], at: list[int], place: list[int] | range) -> None:
            for group in stretches(run, at, own, most, need):
                for _, lo, hi in group:  # the fullest first; the next ones only if the order of words is another one there
                    if tried(run[lo:hi], place[lo:hi]):
                        break

        from_every_place(ws, at, range(len(ws)))
        if len(template) <= PHRASE or best and best[0] == len(template):
            return best
        left, size = [ws[i] for i in at], most
        from_every_place(left, list(range(len(at))), at)
        while size < len(left):
            size *= 2
            for lo in range(0, max(1, len(left) - size // 2), size // 2):
                tried(left[lo : lo + size], at[lo : lo + size])
        return best


def stretches(ws: list[str], at: list[int], template: Counter, most: int, need: float) -> list[list[tuple[int, int, int]]]:
    """Runs of stretches (-words shared, start, end) of at most `most` words that share at least `need` words with the template,
    each word as often as both have it. Stretches start at the positions `at` and follow one another in a run; the fullest come first."""
    out, have, shared, end, last = [], Counter(), 0, 0, -2
    for k, lo in enumerate(at):
        while end < len(at) and at[end] < lo + most:
            w = ws[at[end]]
            shared += have[w] < template[w]
            have[w] += 1
            end += 1
        if shared >= need:
            if last != k - 1:
                out.append([])
            out[-1].append((-shared, lo, at[end - 1] + 1))
            last = k
        have[ws[lo]] -= 1
        shared -= have[ws[lo]] < template[ws[lo]]
    return [sorted(r) for r in out]


def licenses(documents: DataFrame, templates: dict[str, tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """A row for each document and each template that it covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, names = Scanner(templates, least), [x.split() for x in SCHEMA.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        for b in slices(batches):
            rows = [(d, *m) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in scanner.scan(t)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[kind]) for i, (_, kind) in enumerate(names)], [n for n, _ in names])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(read(spark, sf_dir, "documents"))
