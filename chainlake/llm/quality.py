"""Quality by weak supervision, in DataFrame expressions alone.

Rules look at a document's counts and vote good (1), bad (0) or abstain (null). They are strict: many a good document breaks one.
Expectation-maximisation over the table of vote patterns estimates how often each rule is right about good and about bad documents, and how many are
good. A document is kept if its posterior probability of being good reaches `least`, in place of having to satisfy every rule: a vote counts for
as much as the rule's agreement with the others says, and one that says bad of a good document now and then is outvoted.

The counts of each document are written once. Estimates are made from all documents that pass the base rules, those that are to be
judged. Patterns are aggregated (at most 3 ** rules rows, whatever the corpus), and each EM step is one aggregation over that table; only the
estimates come to the driver.

Which class is the good one is fixed by each rule being right more often than by chance: its rate of voting bad about bad documents stays above that
about good ones. Nothing else holds the estimates but MOST_RIGHT.

Defined cases: a null or empty text has no words, so it fails the base rules; very long texts are counted whole; repeated rows and
null ids are rows like others; where no document passes the base rules the estimates are their starts; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import read, saved

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 50
STEPS, TOLERANCE = 50, 1e-5
MOST_RIGHT = 0.999
#: Where the estimates start: the share of good documents, and a rule's rates of being right about good and about bad ones. A fault is one of several,
#: so a rule sees few bad documents.
GOOD, START_GOOD, START_BAD = 0.8, 0.9, 0.3
#: A rule's rate of voting bad about bad documents exceeds that about good ones by so much.
APART = 1e-4
KEEP = 0.5
#: Bits of a window's sort key that hold its position: an array has no more places.
_AT = 31


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that the text has twice or more. Windows are sorted as hash bits and position in one long;
    those that stand beside equal bits are candidates. Where words of such neighbours differ, candidates are sorted again by
    their words, so that equal windows stand together whatever their hashes. The lengths of the covered stretches are added up."""
    mask, n = F.lit((1 << _AT) - 1), F.size(words)
    place = lambda x: x.bitwiseAND(mask).cast("int")
    bits = lambda x: F.shiftrightunsigned(x, _AT)
    true = lambda c: F.coalesce(c, F.lit(False))
    keys = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.shiftleft(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), _AT).bitwiseOR(i.cast("long")))
    windows = F.when(n >= 3, F.sort_array(keys)).otherwise(F.array().cast("array<long>"))

    def equal(x: Column, y: Column) -> tuple[Column, ...]:
        return F.get(words, x) == F.get(words, y), F.get(words, x + 1) == F.get(words, y + 1), F.get(words, x + 2) == F.get(words, y + 2)

    def beside(s: Column, same: Callable[[Column, Column], Column]) -> Column:
        return F.filter(s, lambda x, i: true(same(x, F.get(s, i + 1))) | true(same(x, F.get(s, i - 1))))

    def by_words(c: Column) -> Column:
        whole = F.sort_array(F.transform(c, lambda x: F.struct(*[F.get(words, place(x) + k).alias(f"w{k}") for k in range(3)], place(x).alias("p"))))
        return F.transform(_let(whole, lambda s: beside(s, lambda x, y: (x["w0"] == y["w0"]) & (x["w1"] == y["w1"]) & (x["w2"] == y["w2"]))), lambda x: x["p"])

    def places(c: Column) -> Column:
        def differ(x: Column, y: Column) -> Column:
            first, second, third = equal(place(x), place(y))
            return (bits(x) == bits(y)) & ~(first & second & third)

        clash = F.exists(F.transform(c, lambda x, i: true(differ(x, F.get(c, i + 1)))), lambda x: x)
        return F.when(clash, by_words(c)).otherwise(F.transform(c, place))

    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("end"))
    at = F.sort_array(_let(_let(windows, lambda s: beside(s, lambda x, y: bits(x) == bits(y))), places))
    return F.aggregate(at, start, lambda a, p: F.struct((a["sum"] + p + 3 - F.greatest(a["end"], p)).alias("sum"), (p + 3).alias("end")), lambda a: a["sum"])


def counts(documents: DataFrame) -> DataFrame:
    """doc_id and what the rules look at, all long."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_words = _let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated")))
    by_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"), F.size(F.filter(x, lambda y: y.rlike(r"[.!?][\x20\x09-\x0D]*$"))).alias("ended")))
    chars = F.length("text")
    found = {
        "n_words": F.col("w.n"), "word_chars": _without(F.col("text"), SPACE), "n_symbols": chars - _without(F.col("text"), SYMBOLS),
        "n_dup_lines": F.col("l.dup"), "n_repeat_words": F.col("w.repeated"), "n_lines": F.col("l.n"), "n_ended": F.col("l.ended"),
        "n_upper": chars - _without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "n_marks": chars - _without(F.col("text"), "!?"), "n_digits": chars - _without(F.col("text"), "0123456789"),
    }
    return d.select("doc_id", "text", by_words.alias("w"), by_lines.alias("l")).select("doc_id", *[c.cast("long").alias(k) for k, c in found.items()])


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1)


def rules() -> dict[str, Column]:
    """Votes by rule; null abstains. Ratios of texts without words are null, so that most rules abstain there."""
    per = lambda a, b: F.col(a) / F.when(F.col(b) > 0, F.col(b))
    length, symbols, lines, repeats = per("word_chars", "n_words"), per("n_symbols", "n_words"), per("n_dup_lines", "n_lines"), per("n_repeat_words", "n_words")
    density, marks_share = per("n_symbols", "word_chars"), per("n_marks", "word_chars")
    upper, marks, ended, digits = per("n_upper", "word_chars"), per("n_marks", "n_words"), per("n_ended", "n_lines"), per("n_digits", "word_chars")
    return {
        "long_enough": _vote(F.col("n_words") >= 4 * MIN_WORDS, F.col("n_words") < 2 * MIN_WORDS),
        "word_length": _vote(length.between(3.5, 8), ~length.between(3, 10)),
        "few_symbols": _vote(symbols <= 0.05, symbols > 0.1),
        "symbol_density": _vote(density <= 0.01, density > 0.02),
        "mostly_letters": _vote(density + marks_share + digits <= 0.05, density + marks_share + digits > 0.1),
        "lines_differ": _vote(lines <= 0.1, lines > 0.2),
        "words_differ": _vote(repeats <= 0.1, repeats > 0.2),
        "lower_case": _vote(upper <= 0.1, upper > 0.2),
        "calm": _vote(marks <= 0.05, marks > 0.1),
        "sentences": _vote(ended >= 0.8, ended < 0.5),
        "few_digits": _vote(digits <= 0.05, digits > 0.1),
    }


class Estimates:
    """Share of good documents, and by rule how often a vote is right about good and about bad ones."""

    def __init__(self, names: list[str]):
        self.good, self.right = GOOD, {k: (START_GOOD, START_BAD) for k in names}

    def posterior(self) -> Column:
        """The probability of "good" from the columns of votes."""
        odds = F.log(F.lit(self.good / (1 - self.good)))
        for k, (a, b) in self.right.items():
            odds = odds + F.when(F.col(k) == 1, F.log(F.lit(a / (1 - b)))).when(F.col(k) == 0, F.log(F.lit((1 - a) / b))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))

    def step(self, patterns: DataFrame) -> float:
        """One round of EM; the largest change of an estimate."""
        p, n = F.col("posterior"), F.col("n")
        sums = {"all": F.sum(n), "good": F.sum(n * p)}
        for k in self.right:
            v = F.col(k)
            sums |= {f"{k}_1": F.sum(F.when(v == 1, n * p)), f"{k}_g": F.sum(F.when(v.isNotNull(), n * p)), f"{k}_0": F.sum(F.when(v == 0, n * (1 - p))), f"{k}_b": F.sum(F.when(v.isNotNull(), n * (1 - p)))}
        r = patterns.withColumn("posterior", self.posterior()).agg(*[c.alias(k) for k, c in sums.items()]).first()
        if not r["all"]:
            return 0.0
        clip = lambda x, least=1 - MOST_RIGHT: min(MOST_RIGHT, max(least, x))
        rate = lambda k, start: ((r[f"{k[0]}_{k[1]}"] or 0) + start) / ((r[f"{k[0]}_{k[2]}"] or 0) + 1)  # noqa: E731  one vote at the start's rate, for rules that never vote
        was = [self.good, *[x for ab in self.right.values() for x in ab]]
        self.good = clip(r["good"] / r["all"])
        right = {k: clip(rate((k, 1, "g"), START_GOOD)) for k in self.right}
        self.right = {k: (a, clip(rate((k, 0, "b"), START_BAD), 1 - a + APART)) for k, a in right.items()}
        return max(abs(a - b) for a, b in zip(was, [self.good, *[x for ab in self.right.values() for x in ab]], strict=True))


def fit(votes: DataFrame, names: list[str], steps: int = STEPS) -> Estimates:
    patterns = saved(votes.groupBy(*names).agg(F.count("*").alias("n")), "patterns").coalesce(1)
    estimates = Estimates(names)
    for _ in range(steps):
        if estimates.step(patterns) < TOLERANCE:
            break
    return estimates


def assess(documents: DataFrame, keep: float = KEEP) -> DataFrame:
    """Counts, base verdict, posterior and verdict for every row."""
    voting = rules()
    votes = saved(counts(documents).withColumns(voting), "votes")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    good = fit(votes.where(~failed), list(voting)).posterior()
    out = votes.withColumn("good_probability", good)
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(*base, failed.alias("base_failed"), (~failed & (F.col("good_probability") >= keep)).alias("kept"), "good_probability")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(read(spark, sf_dir, "documents"))
