"""URL filtering by a sorted digest array.

The rules' keys (host and path prefix) are kept as a sorted array of 64-bit xxhash values beside the full strings, in one file
that tasks map into memory, so workers of a machine share its pages. Each url gives a key for every suffix of its host at a label
and every path length that some rule has; all keys of a batch are probed by one vectorised binary search, and each hit is confirmed on the stored
string, so a collision can neither block nor allow. The longest fitting rule wins; where none fits, the verdict is `default`.

The file is written to the shared folder and sent to the executors by Spark; urls never leave their task.

A rule fits its host and all subdomains, if the url's path starts with the rule's. Host: after the first "://" up to "/", "?", "#"
or the end, A-Z in lower case; path: from there up to "?", "#" or the end.

Defined cases: a null url or one without "://" has empty host and path, which no rule fits; of rules that say the same key the last
one given holds; equally long fitting rules go by the longer host; repeated rows are judged alike; without rules all get the default; an empty table gives no rows; urls of any length are judged whole, and keys are
made only for path lengths that a rule has; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import filesystem, read, scratch_path, slices

ALLOW, BLOCK = "allow", "block"
#: The production rules: verdict and host with path.
RULES = (
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
)
_HEAD = struct.Struct("<QQ")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    stop = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    rest = rest[:stop]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(_LOWER), slash + path


def build(rules: Sequence[tuple[str, str]]) -> bytes:
    """The index: counts, sorted keys, string ends in key order, verdicts, path lengths, strings."""
    last = {"".join(split_rule(rule)): verdict for verdict, rule in rules}
    texts = {k: k.encode("utf-8", "surrogatepass") for k in last}
    order = sorted(last, key=lambda k: (xxhash.xxh64_intdigest(texts[k]), k))
    keys = np.array([xxhash.xxh64_intdigest(texts[k]) for k in order], "<u8")
    ends = np.cumsum([len(texts[k]) for k in order], dtype="<u8") if order else np.empty(0, "<u8")
    verdicts = np.array([last[k] == BLOCK for k in order], np.uint8)
    paths = np.array(sorted({len(split_rule(k)[1]) for k in order}), "<u8")
    return _HEAD.pack(len(order), len(paths)) + keys.tobytes() + ends.astype("<u8").tobytes() + paths.tobytes() + verdicts.tobytes() + b"".join(texts[k] for k in order)


class Index:
    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        n, paths = _HEAD.unpack(data[: _HEAD.size].tobytes())
        at = _HEAD.size
        self.keys, at = data[at : at + 8 * n].view("<u8"), at + 8 * n
        self.ends, at = data[at : at + 8 * n].view("<u8"), at + 8 * n
        self.paths, at = data[at : at + 8 * paths].view("<u8").tolist(), at + 8 * paths
        self.block, at = data[at : at + n], at + n
        self.texts = data[at:]

    def text(self, i: int) -> bytes:
        return self.texts[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])].tobytes()

    def find(self, keys: list[bytes]) -> list[int]:
        """The place of each key, or -1."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.keys, hashes)
        out = np.full(len(keys), -1, np.int64)
        inside = np.flatnonzero(at < len(self.keys))
        for j in inside[self.keys[at[inside]] == hashes[inside]].tolist():
            i = int(at[j])
            while i < len(self.keys) and self.keys[i] == hashes[j]:  # equal hashes stand together
                if self.text(i) == keys[j]:
                    out[j] = i
                    break
                i += 1
        return out.tolist()

    def judge(self, urls: list[str | None]) -> list[tuple[str, str, str | None, bool]]:
        """Host, path, the longest fitting rule and whether it blocks."""
        parts, keys, owner = [split_url(u) for u in urls], [], []
        for n, (host, path) in enumerate(parts):
            suffixes, at = [host] if host else [], host.find(".")
            while at >= 0:
                if at + 1 < len(host):
                    suffixes.append(host[at + 1 :])
                at = host.find(".", at + 1)
            for length in self.paths:
                if length <= len(path):
                    keys += [(s + path[:length]).encode("utf-8", "surrogatepass") for s in suffixes]
                    owner += [n] * len(suffixes)
        best: dict[int, tuple[int, int, str, int]] = {}
        for n, key, i in zip(owner, keys, self.find(keys), strict=True):
            if i >= 0:
                rule = key.decode("utf-8", "surrogatepass")
                best[n] = max(best.get(n, (0, 0, "", 0)), (len(rule), len(split_rule(rule)[0]), rule, i))
        return [(*part, best[n][2], bool(self.block[best[n][3]])) if n in best else (*part, None, False) for n, part in enumerate(parts)]


def publish(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> str:
    """Write the index to the shared folder and send it to the executors; its file name."""
    path = scratch_path(spark, "url-rules") + ".idx"
    fs, p = filesystem(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(build(rules)))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, default: str = ALLOW) -> DataFrame:
    """page_id, host, path, rule and verdict of every row."""
    name = publish(pages.sparkSession, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(SparkFiles.get(name))
        for b in slices(batches, 4096):
            rows = index.judge(b.column(1).to_pylist())
            verdicts = [default if r[2] is None else BLOCK if r[3] else ALLOW for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], pa.string()) for i in range(3)], pa.array(verdicts, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


ORACLE_SQL = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '/.*$', 0, 's') AS path FROM u),
r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) t(rhost, rpath, verdict)),
f AS (SELECT page_id, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS n
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f ON p.page_id = f.page_id AND f.n = 1"""
