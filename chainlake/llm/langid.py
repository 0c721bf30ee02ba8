"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle).

Learning counts the 1- to 3-grams of letters of every labelled text, pre-aggregated in each partition, and keeps
the `profile` most frequent of each language in rank order. A document gets the language whose profile has the least
out-of-place distance from the document's own ranking: for each of the document's grams the difference of the two
ranks, and `profile` for a gram that the language lacks. Ties of counts go by the gram's code points, ties of
distances by the language's name, so results do not depend on partitions.

Defined cases: a null text or one without a letter is `und` with score 0, as is everything where nothing could be
learned; null labels and null texts teach nothing; a null doc_id is neither trained on nor held out; repeated rows count as often as
they occur; other columns pass or are ignored, whatever their names. Texts of any length are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlake.llm.common import slices

PROFILE = 300
FOLDS = 5
UND = "und"
#: Profiles are held by every task; a label set larger than this is not one of languages.
MAX_LANGUAGES = 4096
#: The pipeline rejects a document below this score whatever was learned: its ranking has next to nothing in common with any profile.
MIN_SCORE = 0.02
#: Least scores are learned from so many labelled texts or more, by language and LENGTHS classes of length, and lie half-way from what
#: texts get by other languages' profiles (the median) to what all but LOW of them get by their own.
LEAST_TEXTS, LENGTHS, LOW = 100, 3, 0.005

_alpha: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _alpha
    if _alpha is None:
        _alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _alpha


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of the 1- to 3-grams within words (a blank marks a word's edge) and how often each occurs.
    A gram's code holds its code points, 21 bits each."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not text:
        return none
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return none
    c = np.full(len(points) + 2, 32, np.int64)
    c[1:-1][letter] = points[letter]
    blank = c == 32
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]
    c = c[keep]
    blank = c == 32
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    codes = np.sort(np.concatenate([c[~blank], two, three[~blank[1:-1]]]))
    edge = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[edge], np.diff(np.append(edge, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, k: int = PROFILE) -> np.ndarray:
    """The k most frequent grams, most frequent first; ties by code. `codes` ascend."""
    return codes[np.argsort(-counts, kind="stable")[:k]]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for b in slices(batches):
        new: dict[str, list] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            new.setdefault(lang, []).append(gram_counts(text))
        for lang, parts in new.items():
            total[lang] = _merge([*parts, *([total[lang]] if lang in total else [])])
    for lang, (codes, counts) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], ["lang", "code", "n"])


def train(labelled: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """labelled(lang, text) to each language's grams in rank order. Only the finished profiles reach the driver."""
    labelled = labelled.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    counts = labelled.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("rank") <= profile)
    found: dict[str, list[tuple[int, int]]] = {}
    for r in top.select("lang", "rank", "code").toLocalIterator():
        found.setdefault(r.lang, []).append((r.rank, r.code))
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} different languages are labelled")
    return {lang: [c for _, c in sorted(found[lang])] for lang in sorted(found)}


class Profiles:
    """The learned rankings as one matrix: languages by all their grams."""

    def __init__(self, model: dict[str, list[int]], profile: int = PROFILE):
        self.langs, self.k = sorted(model), profile
        self.codes = np.array(sorted({c for v in model.values() for c in v}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), -1, np.int32)
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.codes, model[lang])] = np.arange(len(model[lang]))

    def distances(self, text: str | None) -> tuple[np.ndarray, int]:
        """The distance from each language's profile, and the number of ranked grams; none of either for a text without letters."""
        grams = ranked(*gram_counts(text), self.k)
        if not len(grams) or not self.langs:
            return np.empty(0, np.int64), 0
        at = np.searchsorted(self.codes, grams)
        at[at == len(self.codes)] = 0
        at[self.codes[at] != grams] = len(self.codes)
        ranks = self.ranks[:, at]
        return np.where(ranks < 0, self.k, np.abs(ranks - np.arange(len(grams)))).sum(axis=1), len(grams)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 less the distance as a share of the largest that is possible."""
        return self._best(*self.distances(text))

    def _best(self, away: np.ndarray, n: int) -> tuple[str, float]:
        if not n:
            return UND, 0.0
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.k * n))

    def known(self, text: str | None, least: Least, min_score: float) -> bool:
        """Whether the language is recognised: the score is min_score and the learned least one of language and length, or more."""
        away, n = self.distances(text)
        lang, score = self._best(away, n)
        return lang != UND and score >= max(min_score, least.of(lang, _length(n, self.k)))


def _length(n: int, k: int) -> int:
    """The class of length of a text of n ranked grams; the last one is of full rankings."""
    return n * LENGTHS // k


class Least:
    """Least scores by language and class of length; None stands for all. What has too few texts goes by all languages of
    that length, by the language at any length, or by all texts, the first of these that has enough."""

    def __init__(self, found: dict[tuple[str | None, int | None], float]):
        self.found = found

    def of(self, lang: str, length: int) -> float:
        return next((self.found[k] for k in ((lang, length), (None, length), (lang, None), (None, None)) if k in self.found), 0.0)


def least_scores(labelled: DataFrame, model: dict[str, list[int]], profile: int = PROFILE) -> Least:
    """From labelled(lang, text), all of it: each text's score by its own language's profile and the best one by another's, which is what a
    language gets that no label teaches. Scores are counted by thousandths, so quantiles are exact to that and of bounded size."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(model, profile)
        place = {lang: i for i, lang in enumerate(profiles.langs)}
        counts: dict[tuple[str, int, bool, int], int] = {}
        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                away, n = profiles.distances(text)
                if not n or lang not in place:
                    continue
                own = int(away[place[lang]])
                other = np.delete(away, place[lang])
                for foreign, x in ((False, own), *([(True, int(other.min()))] if len(other) else [])):
                    key = lang, _length(n, profile), foreign, round(1000 * (1 - x / (profile * n)))
                    counts[key] = counts.get(key, 0) + 1
        columns = list(zip(*counts, strict=True)) or [()] * 4
        types = pa.string(), pa.int32(), pa.bool_(), pa.int32()
        yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.array(counts.values(), pa.int64())], ["lang", "length", "other", "score", "n"])

    counts = labelled.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(score, "lang string, length int, other boolean, score int, n long")
    counts = counts.groupBy("lang", "length", "other", "score").agg(F.sum("n").alias("n"))
    at = lambda other, q: F.percentile(F.when(F.col("other") == other, F.col("score")), q, F.col("n")) / 1000
    found = {}
    for r in counts.cube("lang", "length").agg(F.sum(F.when(~F.col("other"), F.col("n"))).alias("n"), at(False, LOW).alias("own"), at(True, 0.5).alias("foreign")).where(F.col("n") >= LEAST_TEXTS).toLocalIterator():
        found[r.lang, r.length] = min(r.own, (r.own + (r.foreign or 0.0)) / 2)
    return Least(found)


def predictor(model: dict[str, list[int]], profile: int = PROFILE):
    """A column function of text: struct(lang_pred, score). Not deterministic by name only, so that Spark runs it once a row."""
    made: list[Profiles] = []

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(Profiles(model, profile))
        out = [made[0].predict(t) for t in texts]
        return pd.DataFrame({"lang_pred": [x[0] for x in out], "score": [x[1] for x in out]}, columns=["lang_pred", "score"])

    return predict.asNondeterministic()


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learned from the rows outside fold 0 alone."""
    d = documents.select("doc_id", "text", "lang")
    predict = predictor(train(d.where(fold() != 0)))
    out = d.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), predict("text").alias("found"))
    return out.select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_known(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose language is recognised: neither `und` nor below min_score or the least score that the labelled texts teach."""
    labelled = documents.where(fold() != 0)
    model = train(labelled)
    least, made = least_scores(labelled, model), []

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(Profiles(model))
        return pd.Series([made[0].known(t, least, min_score) for t in texts], dtype=bool)

    return documents.where(known.asNondeterministic()("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
