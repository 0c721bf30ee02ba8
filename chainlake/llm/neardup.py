"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles, banded, then verified.

A shingle is five words in a row (a shorter text is one shingle). Its weight is how often the text has it, times the mean
inverse document frequency of its words. Similarity is weighted Jaccard over these weights; texts of `threshold` or more
are linked, and classes are the connected components.

* Frequencies are counted over all documents, by word hash in 2**16 counters; so what each task holds does not
  grow with the corpus, and words that share a counter share a weight. Word frequencies are used as those of shingles would
  make what thousands of copies share cheap and their few differences dear, and so would part true copies.
* Texts of equal words are one node from the first aggregation on, however many copies there are.
* A sample of a text is the shingle and quantised weight that minimise ln c - r (t - beta + 1), where r, c ~ Gamma(2, 1)
  and beta ~ U(0, 1) come from the shingle's hash (Ioffe 2010). BANDS bands of ROWS samples are the buckets.
* No bucket is gathered in a task, and no bucket's pairs are listed. First every member is compared with its bucket's most central
  member, the one whose buckets are the largest (in a group of copies that is the text they were made from), and with the next two in
  the order of signatures, in parts of PART members. That links nearly all there is to link. Then members of different components
  that share a bucket are compared, which leaves no pair out: of two such members one is outside the bucket's largest component.
* The members of a bucket of more than HOT, say of a line that very many short texts share, are also put into the buckets that it makes with each of
  their further bands, which links more of them at first. The second comparison is of the whole bucket, dealt to tasks in blocks of HOT by HOT.
* Pairs are tested by their samples, kept as 3 bits each, inside the join, and only likely ones leave it: 135 samples first, and 285 for those
  members of different components, where a large group of copies that are less alike than the threshold would have most pairs near it.
* Every such pair is verified on its whole texts. Joins are on nodes or buckets, both sides shuffled unless the written
  table is small, so that skewed ones are split at run time.

Defined cases: texts of any length are used whole; an empty table gives no rows; texts without a word (null and empty too) are one class if their raw text is equal, null counting as empty; a
null doc_id sorts last, and a class of null ids has a null class_id; repeated rows are copies; other columns are ignored, or kept by
keep_one, whatever their names.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlake.llm.common import NO_ID, read, row_id, saved, slices, split_by, unused
from chainlake.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
#: Samples are packed fifteen to a long, 3 bits and a free one each: so many longs for all texts, and for those of buckets with several components.
PACK = 15
LONGS, FINE = 9, 19
PART, NEXT = 250, 2
#: A bucket of more members gets others beside it by BANDS further bands, from samples of their own, and is compared in blocks of so many.
HOT = 5000
BUCKETS = 1 << 16
POOL = 1 << 16
#: Pairs at the threshold that have fewer equal samples than least_equal says, this share of them, are not verified. The bands miss more: two in 1000 at 0.80.
MISS = 1e-4
#: Pairs that a task verifies; on so many that there would be more tasks than WAVES for each core, they take more.
PAIRS, WAVES = 2000, 32
_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_IN_WORD = np.array([i >= 128 or chr(i).isalnum() or i == 95 for i in range(256)])
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            _powers[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n + n // 8, base, np.uint64)]))
    return _powers


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text's words start (one place more than texts). Words are runs of ASCII
    letters, digits, "_" and of characters beyond ASCII, in lower case. All texts at once: a word's hash is a difference of polynomial prefix sums."""
    texts = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if offsets[-1] == offsets[0]:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside, edge = _IN_WORD[data], np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    power, inverse = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U64(1)) * power[: len(data)], out=sums[1:])
    return _mix((sums[end] - sums[start]) * inverse[start]), np.searchsorted(start, offsets)


def shingles(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of a text's shingles, and their weights."""
    k = min(WORDS, len(words))
    if not k:
        return np.empty(0, np.uint64), np.empty(0, np.float64)
    n = len(words) - k + 1
    mean = idf[words >> _U64(48)]
    h, w = words[:n].copy(), mean[:n].copy()
    for j in range(1, k):
        h = h * _U64(_BASE) + words[j : j + n]
        w += mean[j : j + n]
    h = _mix(h)
    order = np.argsort(h)
    h = h[order]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[edge], (w[order] / k)[edge] * np.diff(np.append(edge, n))


class Sampler:
    """Draws for each shingle hash come from a pool of POOL triples, at a place that depends on hash and sample."""

    def __init__(self, longs: int = LONGS):
        samples = PACK * longs
        g = np.random.Generator(np.random.PCG64(20240501))
        self.r = g.gamma(2, 1, POOL).astype(np.float32)
        self.ln_c = np.log(g.gamma(2, 1, POOL)).astype(np.float32)
        self.beta = g.random(POOL).astype(np.float32)
        self.step = ((g.integers(1, 1 << 62, samples, dtype=np.uint64) << _U64(1)) | _U64(1))[:, None]
        self.rows = np.arange(samples)

    def sample(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Samples of 64 bits; each is the same for two texts with the probability of their weighted Jaccard similarity."""
        ln_w, least, which, level = np.log(w).astype(np.float32), None, None, None
        for at in range(0, len(h), 2048):  # long texts in parts, to stay in the cache
            place = h[None, at : at + 2048] * self.step
            place >>= _U64(48)
            place = place.view(np.int64)
            r, beta = self.r.take(place, mode="clip"), self.beta.take(place, mode="clip")
            t = ln_w[None, at : at + 2048] / r
            t += beta
            np.floor(t, out=t)
            key = self.ln_c.take(place, mode="clip")  # ln c - r (t - beta + 1), the last two terms added up before
            np.subtract(t, beta, out=beta)
            beta += np.float32(1)
            beta *= r
            key -= beta
            best = key.argmin(axis=1)
            low, own, steps = key[self.rows, best], h[at + best], t[self.rows, best]
            if least is None:
                least, which, level = low, own, steps
            else:
                less = low < least
                least, which, level = np.where(less, low, least), np.where(less, own, which), np.where(less, steps, level)
        return _mix(which + level.astype(np.int64).astype(np.uint64) * _U64(_BASE))


def band_hashes(samples: np.ndarray) -> np.ndarray:
    """The hashes of BANDS bands, and of as many further ones."""
    out = np.arange(1, 2 * BANDS + 1, dtype=np.uint64)
    for part in samples[: 2 * BANDS * ROWS].reshape(2 * BANDS, ROWS).T:
        out = _mix(out * _U64(_BASE) + part)
    return out.view(np.int64)


def packed(samples: np.ndarray) -> np.ndarray:
    return ((samples.reshape(-1, PACK) >> _U64(61)) << (_U64(4) * np.arange(PACK, dtype=np.uint64))).sum(axis=1, dtype=np.uint64).view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    high = a[1].sum() + b[1].sum() - low
    return float(low / high) if high else 1.0


def least_equal(threshold: float, longs: int, miss: float = MISS) -> int:
    """The most equal samples, of so many longs, that all but a share `miss` of the pairs at the threshold have at least: a sample of 3 bits
    is equal for the similarity, or in one case of eight by chance."""
    n, p, below = PACK * longs, threshold + (1 - threshold) / 8, 0.0
    for k in range(n + 1):
        below += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if below > miss:
            return k
    return n


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, docs = np.zeros(BUCKETS, np.int64), 0
    for b in slices(batches):
        words, at = words_of(b.column(0))
        owner = np.repeat(np.arange(b.num_rows, dtype=np.uint64), np.diff(at))
        counts += np.bincount((np.unique((owner << _U64(16)) | (words >> _U64(48))) & _U64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        docs += b.num_rows
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], docs))], ["bucket", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The weight of each word bucket, from all texts: BUCKETS numbers whatever the corpus. From 1 for a word that all have to 2 for a rare
    one, so that a few rare words cannot outweigh what two texts share."""
    out, docs_n = np.zeros(BUCKETS), 0
    for r in docs.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r.bucket < 0:
            docs_n = r.n
        else:
            out[r.bucket] = r.n
    return 1 + np.log((1 + docs_n) / (1 + out)) / np.log(2 + docs_n)


def _signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(id, raw, node, bands, sig) of each row: `node` is 128 bits of the words, `raw` 64 of the text; the others are null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for b in slices(batches):
            nodes, bands, sigs = [], [], []
            words, at = words_of(b.column(2))
            for i, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                if lo < hi:
                    nodes.append(xxhash.xxh3_128_digest(words[lo:hi].tobytes(), 1))
                    samples = sampler.sample(*shingles(words[lo:hi], idf))
                    band, sig = band_hashes(samples), packed(samples)
                else:
                    nodes.append(xxhash.xxh3_128_digest((b.column(2)[i].as_py() or "").encode("utf-8", "surrogatepass"), 2))
                    band = sig = None
                bands.append(band)
                sigs.append(sig)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes, pa.binary()), pa.array(bands, longs), pa.array(sigs, longs)], ["id", "raw", "node", "bands", "sig"])

    return docs.mapInArrow(sign, "id long, raw long, node binary, bands array<long>, sig array<long>")


def _fine(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """texts(node, text) to (node, fine), a signature of more samples."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(FINE)
        for b in slices(batches):
            words, at = words_of(b.column(1))
            sigs = [packed(sampler.sample(*shingles(words[lo:hi], idf))) for lo, hi in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigs, pa.list_(pa.int64()))], ["node", "fine"])

    return texts.mapInArrow(sign, "node binary, fine array<long>")


def _equal(a: str, b: str, longs: int) -> F.Column:
    """Equal samples of two packed signatures: three bits of the difference are 0, or adding 7 sets the fourth."""
    ones, tops = F.lit(0x0777777777777777), F.lit(0x0888888888888888)
    return F.lit(PACK * longs) - sum(F.bit_count((F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))) + ones).bitwiseAND(tops)) for i in range(longs))


def _ordered(a: str, b: str) -> list[F.Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _texts(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of nodes(node, id, raw), written; one row a node. Only texts that may be wanted are joined, so the plan is the same at every size."""
    may, _ = split_by(docs, nodes, ["id", "raw"])
    return saved(may.join(nodes, ["id", "raw"]).select("node", "text").dropDuplicates(["node"]), "texts")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (u, v) whose whole texts are similar."""
    texts = _texts(saved(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().join(nodes, "node").select("node", "id", "raw"), "keys"), docs)
    both = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("tu")), "u").join(texts.select(F.col("node").alias("v"), F.col("text").alias("tv")), "v")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[bytes, tuple[np.ndarray, np.ndarray]] = OrderedDict()

        def of(node: bytes, text: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
            if node not in known:
                known[node] = shingles(words_of(pa.array([text.as_py()], pa.string()))[0], idf)
                if len(known) > 64:
                    known.popitem(last=False)
            return known[node]

        for b in slices(batches):
            u, v, (tu, tv) = b.column(0).to_pylist(), b.column(1).to_pylist(), b.columns[2:]
            keep = [weighted_jaccard(of(u[i], tu[i]), of(v[i], tv[i])) >= threshold for i in range(len(u))]
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    spark = pairs.sparkSession  # few bytes, but much to compute: not to be coalesced by size, nor to be dealt to more tasks than the cluster has use for
    tasks = min(-(-pairs.count() // PAIRS), max(int(spark.conf.get("spark.sql.shuffle.partitions")), WAVES * spark.sparkContext.defaultParallelism))
    return both.select("u", "v", "tu", "tv").repartition(tasks).mapInArrow(check, "u binary, v binary")


def classes(documents: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Written tables: (id, raw, node) of each row, and (node, id, raw, class) of each different text, where id and raw name its
    first row and class is a node that stands for the class. A threshold under THRESHOLD is refused, as the bands would miss much of it."""
    if not THRESHOLD <= threshold <= 1:
        raise ValueError(f"the bands are made for similarities from {THRESHOLD} to 1, not for a threshold of {threshold}")
    least_coarse = least_equal(threshold, LONGS)
    docs = documents.select(row_id().alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("raw"), "text")
    idf = inverse_frequencies(docs)
    rows = saved(_signatures(docs, idf), "signatures")
    first = F.min(F.struct("id", "raw")).alias("first")
    nodes = saved(rows.groupBy("node").agg(first, F.first("bands").alias("bands"), F.first("sig").alias("sig")).select("node", "first.id", "first.raw", "bands", "sig"), "nodes")
    signed = nodes.where("sig IS NOT NULL")
    members = signed.select("node", F.posexplode(F.slice("bands", 1, BANDS)).alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = saved(members.join(shared, "bucket"), "members")
    whole, hot = members, members.where(F.col("n") > HOT)
    if not hot.isEmpty():  # each member in the further bands too: what is alike most likely shares one of them
        further = signed.select("node", F.explode(F.slice("bands", BANDS + 1, BANDS)).alias("further"))
        split = saved(hot.drop("n").join(further, "node").withColumn("bucket", F.xxhash64("bucket", "further")).drop("further"), "split")
        shared = split.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        members = members.unionByName(split.join(shared, "bucket").select(*members.columns))
    central = members.groupBy("node").agg(F.sum("n").alias("score")).join(nodes.select("node", "sig"), "node")
    members = saved(members.join(central, "node").select("band", "bucket", "n", F.struct("score", "node", "sig").alias("m")), "members")

    # a bucket is dealt to as many tasks as it has parts, and so is what its members are compared with
    parts_of = F.ceil(F.col("n") / PART).cast("long")
    dealt = members.select("bucket", F.pmod(F.xxhash64("m.node"), parts_of).alias("salt"), "m")
    heads = members.groupBy("bucket").agg(F.max("m").alias("lead"), F.first("n").alias("n")).select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), parts_of - 1)).alias("salt"), "lead")
    follow = Window.partitionBy("bucket", "salt").orderBy("m.sig", "m.node")
    neighbours = dealt.select("m", *[F.lead("m", k).over(follow).alias(f"m{k}") for k in range(1, NEXT + 1)])
    neighbours = neighbours.select("m", F.explode(F.array(*[f"m{k}" for k in range(1, NEXT + 1)])).alias("lead")).where(F.col("lead").isNotNull() & (_equal("m.sig", "lead.sig", LONGS) >= least_coarse)).select(*_ordered("m.node", "lead.node"))
    to_heads = dealt.join(heads, ["bucket", "salt"]).where((F.col("m.node") != F.col("lead.node")) & (_equal("m.sig", "lead.sig", LONGS) >= least_coarse)).select(*_ordered("m.node", "lead.node"))
    pairs = saved(to_heads.union(neighbours).distinct(), "pairs")
    links = parts = None
    if not pairs.isEmpty():
        links = saved(_verified(pairs, nodes, docs, idf, threshold), "links")
        parts = components(links)
        members, fine, same = whole.select("band", "bucket", "node"), None, F.col("x.bucket") == F.col("y.bucket")
        once = ~F.arrays_overlap(F.slice("x.bands", F.lit(1), F.col("x.band")), F.slice("y.bands", F.lit(1), F.col("y.band")))  # in the first bucket that both are in
        # of members of different components the likeliest pairs come first, as they join most components
        for least in (least_equal(threshold, FINE, 0.25), least_equal(threshold, FINE)):
            part = parts.select(F.col("u").alias("node"), F.col("v").alias("part"))
            placed = saved(members.join(part, "node", "left").withColumn("part", F.coalesce("part", "node")), "placed")
            largest = placed.groupBy("bucket", "part").agg(F.count("*").alias("size")).groupBy("bucket").agg(F.max(F.struct("size", "part")).alias("largest"), F.sum("size").alias("all"), F.count("*").alias("parts")).where("parts > 1")
            blocks = [F.ceil(c / HOT).cast("int").alias(k) for k, c in (("rows", F.col("all")), ("columns", F.col("all") - F.col("largest.size")))]
            placed = placed.join(largest.select("bucket", F.col("largest.part").alias("largest"), *blocks), "bucket")
            if fine is None:
                fine = saved(_fine(_texts(saved(placed.select("node").distinct().join(nodes, "node").select("node", "id", "raw"), "keys"), docs), idf).join(nodes.select("node", "bands"), "node"), "fine")
            placed = saved(placed.join(fine, "node"), "placed")
            own = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
            every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
            x = placed.withColumn("row", own("rows")).withColumn("column", every("columns")).alias("x")
            y = placed.where("part <> largest").withColumn("column", own("columns")).withColumn("row", every("rows")).alias("y")
            likely = same & (F.col("x.row") == F.col("y.row")) & (F.col("x.column") == F.col("y.column")) & (F.col("x.part") != F.col("y.part")) & (_equal("x.fine", "y.fine", FINE) >= least) & once
            rest = saved(x.join(y, likely).select(*_ordered("x.node", "y.node")).distinct().join(pairs, ["u", "v"], "left_anti"), "pairs")
            if not rest.isEmpty():
                links = links.unionByName(saved(_verified(rest, nodes, docs, idf, threshold), "links"))
                parts, pairs = components(links), pairs.unionByName(rest)
    out = nodes.select("node", "id", "raw")
    if parts is None:
        out = out.withColumn("class", F.col("node"))
    else:
        out = out.join(parts.select(F.col("u").alias("node"), F.col("v").alias("class")), "node", "left").withColumn("class", F.coalesce("class", "node"))
    return rows.select("id", "raw", "node"), saved(out, "classes")


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document: class_id is the least doc_id of its class, class_texts the class's number of different
    texts, kept whether it is the row that stands for the class (all rows that share that doc_id and text, if there are several)."""
    rows, texts = classes(documents, threshold)
    heads = texts.groupBy("class").agg(F.min(F.struct("id", "raw")).alias("head"), F.count("*").alias("class_texts"))
    texts = texts.join(heads, "class").select("node", "head", "class_texts")
    real = lambda c: F.when(c != NO_ID, c)
    return rows.join(texts, "node").select(real(F.col("id")).alias("doc_id"), real(F.col("head.id")).alias("class_id"), "class_texts", (F.struct("id", "raw") == F.col("head")).alias("kept"))


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, the one with the least doc_id; all columns kept."""
    rows, texts = classes(documents, threshold)
    heads = texts.groupBy("class").agg(F.min(F.struct("id", "raw")).alias("head")).select("head.id", "head.raw")
    gone = saved(rows.select("id", "raw").join(heads, ["id", "raw"], "left_anti").distinct(), "gone")
    i, r = unused(documents.columns, "id", "raw")
    keyed = documents.withColumns({i: row_id(), r: F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    again = rows.groupBy("id", "raw").count().where("count > 1").select("id", "raw")  # one of repeated rows stays
    touched = saved(gone.union(again).distinct().select(F.col("id").alias(i), F.col("raw").alias(r)), "touched")
    may, rest = split_by(keyed, touched, [i, r])
    kept = may.join(gone.select(F.col("id").alias(i), F.col("raw").alias(r)).hint("merge"), [i, r], "left_anti").dropDuplicates([i, r])
    return kept.unionByName(rest).select(*[F.col(f"`{c}`") for c in documents.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
