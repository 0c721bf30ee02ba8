"""Repeated runs of lines: a suffix array over line ids by distributed prefix doubling, and its LCP intervals.

Every line with a word gets an id, the rank of its 96-bit hash. Only lines that occur more than once can be part of a repeated run; they are
the suffixes. Ranks by the first 2h lines come from sorting the pairs (rank by h lines at p, rank by h lines at p + h) of
one round, so that after round k suffixes are in the order of their first 2**k lines, and those of equal rank are one
interval of the suffix array with a common prefix of that length. Only intervals of two suffixes or more go on.

A run is worth deleting from `min_words` words. As each line has a word, the shortest such run that starts or ends at a
line has at most `min_words` lines, so log2(min_words) rounds are enough, however long a maximal run is: a maximal run is the union
of the shortest ones within it. The suffixes that share such a run's lines are an LCP interval, named by the ranks of the
run's first and last 2**k lines. Within an interval the first suffix stays, by doc_id and line, and the lines of all later copies go.

Each round is an aggregation, a range sort of the distinct pairs and joins on ranks or lines; equal pairs are combined before
the shuffle, results are written, and no interval is gathered, so a passage in a third of all documents is one row of each ranking.

Defined cases: a null text stays null and an empty one empty; blank lines neither count nor go; rows that repeat doc_id and text
are one document and treated alike; null ids sort last; surrounding white space of a line does not count. Texts of any length are used
whole; an empty table gives an empty one. Other columns stay, whatever their names.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import read, row_id, saved, split_by, unused

MIN_WORDS = 50
_BLANK = " \t\r\f\v"
KEY = ["id", "raw"]


def _raw() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _ranked(pairs: DataFrame, by: list[str], tag: str) -> DataFrame:
    """The distinct keys that occur more than once, each with a rank in their order."""
    many = pairs.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return saved(many.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()), tag)


def _windows(js: list[int], ws: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first line, lines) of the shortest runs of min_words words that start or end at each line."""
    out = set()
    first = 0
    for at in range(len(js)):
        if at and js[at] != js[at - 1] + 1:
            first = at
        words, p = 0, at
        while p >= first and words < min_words:
            words += ws[p]
            p -= 1
        if words >= min_words:
            out.add((int(js[p + 1]), at - p))
        words, p = 0, at
        while p < len(js) and js[p] - js[at] == p - at and words < min_words:
            words += ws[p]
            p += 1
        if words >= min_words:
            out.add((int(js[at]), p - at))
    return sorted(out)


def repeated_runs(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A written table (id, raw, runs): for each document with later copies their runs, array of (first line, lines), lines
    with a word counted from 0."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANK))), lambda x: x != "")
    lines = documents.select(row_id().alias("id"), _raw().alias("raw"), F.posexplode(lines).alias("j", "line"))
    lines = lines.select(*KEY, "j", F.xxhash64("line").alias("h"), F.hash("line").alias("g"), F.regexp_count("line", F.lit(r"\S+")).alias("words"))
    names = _ranked(lines, ["h", "g"], "line-names")
    first = saved(lines.join(names, ["h", "g"]).groupBy(*KEY, "j").agg(F.first("words").alias("words"), F.first("rank").alias("rank")), "suffixes")

    @F.pandas_udf("array<struct<s: int, n: int>>")
    def windows(js: pd.Series, ws: pd.Series) -> pd.Series:
        return pd.Series([[{"s": s, "n": n} for s, n in _windows(list(a), list(b), min_words)] for a, b in zip(js, ws, strict=True)])

    each = first.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("j", "words"))).alias("x"))
    each = each.select(*KEY, F.explode(windows("x.j", "x.words")).alias("w")).select(*KEY, "w.s", "w.n")
    runs = saved(each.withColumn("k", F.floor(F.log2(F.col("n") + F.lit(0.5))).cast("int")), "runs")

    ranks, level, k = first.select(*KEY, "j", F.lit(0).alias("k"), "rank"), first.select(*KEY, "j", "rank"), 0
    deepest = runs.agg(F.max("k")).first()[0] or 0
    while k < deepest:
        nxt = level.select(*KEY, (F.col("j") - F.lit(1 << k)).alias("j"), F.col("rank").alias("next"))
        both = saved(level.join(nxt, [*KEY, "j"]), "pairs")
        names = _ranked(both.select(F.col("rank").alias("lead"), "next"), ["lead", "next"], "ranks")
        k += 1
        level = saved(both.withColumnRenamed("rank", "lead").join(names, ["lead", "next"]).select(*KEY, "j", "rank"), "level")
        ranks = ranks.unionByName(level.select(*KEY, "j", F.lit(k).alias("k"), "rank"))
    at = lambda name: ranks.select(*KEY, F.col("j").alias(name), "k", F.col("rank").alias(f"rank_{name}"))
    placed = runs.withColumn("e", (F.col("s") + F.col("n") - F.expr("shiftleft(1, k)")).cast("int")).join(at("s"), [*KEY, "s", "k"]).join(at("e"), [*KEY, "e", "k"])
    interval = ["n", "rank_s", "rank_e"]
    placed = saved(placed.select(*KEY, "s", *interval), "placed")
    heads = placed.groupBy(*interval).agg(F.min(F.struct(*KEY, "s")).alias("head"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    heads = saved(heads, "heads")  # read again, so that the join shuffles for itself and can split a hot interval
    later = placed.join(heads, interval).where(F.struct(*KEY, "s") != F.col("head"))
    return saved(later.groupBy(*KEY).agg(F.collect_list(F.struct("s", "n")).alias("runs")), "later")


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK)) == ""


def without(text: Column, gone: Column) -> Column:
    """The text without its lines at the places `gone`, lines with a word counted from 0."""

    def left(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        counted = F.filter(every, lambda i: ~_blank(F.get(lines, i)))
        stay = lambda c: F.array_except(every, F.transform(gone, lambda j: F.get(c, j)))
        return F.array_join(F.transform(F.transform(F.array(counted), stay)[0], lambda i: F.get(lines, i)), "\n")

    return F.transform(F.array(F.split(text, "\n")), left)[0]


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns, text without its later copies, and as the last column the number of lines that went: `deleted`, or with "_" added where
    the documents have such a column."""
    i, r, later, deleted = unused(documents.columns, "id", "raw", "runs", "deleted")
    found = repeated_runs(documents, min_words).select(F.col("id").alias(i), F.col("raw").alias(r), F.col("runs").alias(later))
    own = [F.col(f"`{c}`") for c in documents.columns]
    changing, rest = split_by(documents.withColumns({i: row_id(), r: _raw()}), found, [i, r])
    joined = changing.join(found.hint("merge"), [i, r], "left")  # runs grow with the corpus: the same plan at every size
    gone = F.array_distinct(F.flatten(F.transform(later, lambda w: F.sequence(w["s"], w["s"] + w["n"] - 1))))
    cleaned = joined.withColumn(later, F.coalesce(gone, F.array().cast("array<int>")))
    text = F.when(F.size(later) > 0, without(F.col("text"), F.col(later))).otherwise(F.col("text")).alias("text")
    cleaned = cleaned.select(*[text if c == "text" else x for c, x in zip(documents.columns, own, strict=True)], F.size(later).alias(deleted))
    return cleaned.unionByName(rest.select(*own, F.lit(0).alias(deleted)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.col("deleted").cast("long").alias("deleted_lines"), "text")
