"""Order-preserving packing of token streams into windows of at most `window` tokens, by dynamic programming.

A document is its token ids and a closing 0. Documents keep their order within an input partition and are packed there, so no
text is shuffled. Windows may be cut after a document, after a sentence, and within a sentence of more than `STRIDE` tokens at
every STRIDE-th of its tokens. The cost of a cut is the padding of the window that it closes (none at a power of two) plus
the truncation penalty of the place: 0 after a document, SENTENCE after a sentence, MIDDLE within one. The least total over all cuts comes from
    f(j) = cut(j) + min over i, pos(j) - window <= pos(i) < pos(j), of f(i) + window - (pos(j) - pos(i))
where the minimum of f(i) + pos(i) over the moving range is kept in a monotone queue, so each place enters and leaves once; a window
of a power of two is a separate candidate at one known place. Streams are solved in blocks of about BLOCK tokens; the last window
of a block goes on into the next one, so a block's end costs nothing, and memory follows the longest document.

Token ids are those of `tokenizers` and its byte-level BPE file. They are computed by tiktoken from the same vocabulary's
ranks, which is five times as fast; a text that holds a special token's string goes to `tokenizers` itself.

Defined cases: null and empty texts are a single 0; repeated rows and null ids are documents like others; texts of any length, of whatever characters,
are encoded whole; of cuts of equal cost the one with the earliest window start of those in the queue is taken, and it before a power of two; an empty table gives no
row; other columns are ignored. Sequence ids are unique, and the same for the same input partitions.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import read, slices

WINDOW = 1024
BLOCK = 1 << 17
SENTENCE, MIDDLE = 4, 48
STRIDE = 96
#: Shorter powers of two would save padding by many tiny sequences.
LEAST_POWER = 128
#: Fixed value: the characters of Unicode's White_Space, which the pre-tokenizer's pattern means.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space of so many characters are encoded by themselves.
LONG_RUN = 1000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _runs_of(n: int):
    return re.compile(f"[{WHITE}]{{{n},}}").finditer


_long_space = _runs_of(LONG_RUN)


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of a text and its closing 0. The tokenizer itself is loaded when a text needs it, as it takes more memory than all the rest."""

    def __init__(self, tokenizer: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(tokenizer, encoding="utf-8") as f:
            whole = json.load(f)
        own = whole["added_tokens"]
        if whole["pre_tokenizer"]["type"] != "ByteLevel" or whole["normalizer"] or set(whole["model"]["vocab"].values()) | {t["id"] for t in own} != set(table.values()) | {t["id"] for t in own}:
            raise ValueError(f"{ranks} and {tokenizer} are different vocabularies")
        self._path, self._slow, self._special = tokenizer, None, [t["content"] for t in own]
        self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.ends = np.zeros(max(max(table.values()), *(t["id"] for t in own)) + 1, bool)
        for token, i in table.items():
            self.ends[i] = token.rstrip(b" ")[-1:] in (b".", b"!", b"?", b"\n")

    def _exact(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
        return self._slow.encode(text, add_special_tokens=False).ids

    def _ordinary(self, text: str) -> list[int]:
        """Long runs of one class of characters are beyond the patterns' engine, so they are cut out where the pattern cuts anyway: before white
        space that follows something else, and before the last character of white space. All of a run before that is one pre-token."""
        if not (runs := list(_long_space(text))):
            return self._fast.encode_ordinary(text)
        ids, at = [], 0
        for m in runs:
            stop = m.end() if m.end() == len(text) else m.end() - 1
            ids += self._fast.encode_ordinary(text[at : m.start()])
            ids += self._fast._encode_single_piece(text[m.start() : stop])
            at = stop
        return ids + self._fast.encode_ordinary(text[at:])

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(1, np.uint32)
        if any(s in text for s in self._special):
            ids = self._exact(text)
        else:
            ids = self._ordinary(text)
        out = np.zeros(len(ids) + 1, np.uint32)
        out[:-1] = ids
        return out


def places(ids: np.ndarray, closes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a window may be cut, and the penalty there. closes: positions just after a document."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[1:][ends[ids]] = SENTENCE
    penalty[closes] = 0
    penalty[0] = 0
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at)
    for a, g in zip(at[:-1][gaps > STRIDE].tolist(), gaps[gaps > STRIDE].tolist(), strict=True):
        penalty[a + STRIDE : a + g : STRIDE] = MIDDLE
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def cuts(at: list[int], penalty: list[int], window: int = WINDOW) -> list[int]:
    """The places of least cost, from 0 to the last. Neighbouring places are at most `window` apart."""
    powers = [p for p in (1 << x for x in range(window.bit_length())) if LEAST_POWER <= p < window]
    index = {p: i for i, p in enumerate(at)}
    cost, back, queue = [0] * len(at), [0] * len(at), deque([0])
    key = [0] * len(at)
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[0]] < p - window:
            queue.popleft()
        best, i = key[queue[0]] + window - p, queue[0]
        for power in powers:
            if (q := index.get(p - power)) is not None and cost[q] < best:
                best, i = cost[q], q
        cost[j], back[j] = best + penalty[j], i
        key[j] = cost[j] + p
        while queue and key[queue[-1]] >= key[j]:
            queue.pop()
        queue.append(j)
    out, j = [], len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return [0, *out[::-1]]


class Packer:
    """Documents in, rows of SCHEMA out, block by block."""

    def __init__(self, ends: np.ndarray, first: int, window: int = WINDOW, block: int = BLOCK):
        self.ends, self.sequence, self.window, self.block = ends, first, window, block
        self.held: list[tuple[int | None, int, int, np.ndarray]] = []  # doc_id, its tokens, start of what is here, ids
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.held.append((doc_id, len(ids), 0, ids))
        self.size += len(ids)
        return self.flush(False) if self.size >= self.block else []

    def flush(self, last: bool) -> list[tuple]:
        if not self.held:
            return []
        ids = np.concatenate([x[3] for x in self.held])
        closes = np.cumsum([len(x[3]) for x in self.held])
        bounds = cuts(*(x.tolist() for x in places(ids, closes, self.ends)), self.window)
        stop = bounds[-1] if last else bounds[-2]
        rows, k, rest, base = [], 0, [], 0
        for doc_id, tokens, start, own in self.held:
            at = 0
            while at < len(own) and base + at < stop:
                while bounds[k + 1] <= base + at:
                    k += 1
                n = min(len(own) - at, bounds[k + 1] - base - at)
                rows.append((doc_id, start + at, n, zlib.crc32(own[at : at + n].astype("<u4").tobytes()), tokens, self.sequence + k, base + at - bounds[k]))
                at += n
            if at < len(own):
                rest.append((doc_id, tokens, start + at, own[at:]))
            base += len(own)
        self.sequence += len(bounds) - 1 if last else len(bounds) - 2
        self.held, self.size = rest, sum(len(x[3]) for x in rest)
        return rows


def pack(documents: DataFrame, window: int = WINDOW, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """A row for each piece of each document."""
    own = default_paths()
    tokenizer, ranks = tokenizer or own[0], ranks or own[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer, ranks)
        packer = Packer(encode.ends, TaskContext.get().partitionId() << 33, window)
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])
        for b in slices(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if rows := packer.add(doc_id, encode(text)):
                    yield batch(rows)
        if rows := packer.flush(True):
            yield batch(rows)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
