"""Helpers shared by the text operators: table access, text slices, hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlab.session import ship_package

SLICE_BYTES = 1 << 20  # text handled at once inside a task; a longer text is a slice of its own

# Multiplier of the rolling hash (odd), and the finalizer of splitmix64.
_BASE = 0x9E3779B97F4A7C15
_MIX1 = 0xBF58476D1CE4E5B9
_MIX2 = 0x94D049BB133111EB
_MASK = (1 << 64) - 1


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of about 8 MB, whatever their length (unless the session asks for less)."""
    if int(spark.conf.get(_BATCH_BYTES).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Numbering(dict):
    """Numbers keys in the order of their first lookup."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def text_key(text: str = "text"):
    """Tells apart rows that share a doc_id: a hash of the text (0 for null)."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def slices(sizes, limit: int = SLICE_BYTES):
    """Consecutive ranges [i, j) of rows with at most ``limit`` bytes in all, or one row."""
    i = total = 0
    for j, n in enumerate(sizes):
        if j > i and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n
    if i < len(sizes):
        yield i, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(_MIX1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(_MIX2)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of the odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int):
        while len(self.up) < n:
            m = len(self.up)
            step = np.uint64(pow(_BASE, m, 1 << 64))
            back = np.uint64(pow(pow(_BASE, -1, 1 << 64), m, 1 << 64))
            self.up = np.concatenate([self.up, self.up * step])
            self.down = np.concatenate([self.down, self.down * back])
        return self.up, self.down


POWERS = Powers()


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for every span of a few hashes, by prefix sums modulo 2**64."""
    n = len(values)
    up, down = POWERS.need(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix64(h ^ mix64((ends - starts).astype(np.uint64)))


_TAILS = np.array([(1 << 8 * b) - 1 for b in range(9)], np.uint64)


def byte_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes buf[start:end] of every (not empty) span.

    Eight bytes at a time enter through the finalizer, together with their number in the span, so no
    structure of the text cancels out as in a polynomial modulo 2**64.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    eights = np.ndarray((len(buf),), "<u8", buf.tobytes() + bytes(8), 0, (1,))
    sizes = ends - starts
    parts = (sizes + 7) >> 3
    first = np.cumsum(parts) - parts
    nth = np.arange(int(first[-1] + parts[-1])) - np.repeat(first, parts)
    number = eights[np.repeat(starts, parts) + 8 * nth] & _TAILS[np.minimum(np.repeat(sizes, parts) - 8 * nth, 8)]
    number += np.uint64(_BASE) * (nth.astype(np.uint64) + np.uint64(1))
    return mix64(np.add.reduceat(mix64(number), first) ^ mix64(sizes.astype(np.uint64)))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, as spans of one byte array."""

    def __init__(self, texts, lower: bool = False):
        raw = [(t or "").encode() for t in texts]
        self.data = b"\n".join(raw)
        buf = np.frombuffer(self.data, np.uint8)
        if lower:
            buf = _LOWER[buf]
        sizes = np.fromiter((len(r) for r in raw), np.int64, len(raw))
        doc_start = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(sizes + 1, out=doc_start[1:])
        inside = np.zeros(len(buf) + 2, np.int8)
        inside[1:-1] = ~_SPACE[buf]
        edges = np.diff(inside)
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        self.hashes = byte_hashes(buf, self.starts, self.ends)
        # words of document i: first[i] .. first[i + 1]
        self.first = np.searchsorted(self.starts, doc_start)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + h[i:len(h) - n + 1 + i]
    return mix64(out)


def as_long(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)
