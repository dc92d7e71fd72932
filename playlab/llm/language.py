"""Language identification by word-first backoff (operator 7).

A text is lower-cased and cut into words (runs of letters).  A word that the model
knows adds its log frequency in each language.  An unseen word falls back to
character n-grams: at each of its positions (one boundary mark before it)
the longest known n-gram that starts there is scored, from ``MAX_GRAM`` down to
one character.  The language with the largest sum wins; ``score`` is its
posterior probability among the learned languages, with equal priors, at the
mean evidence per word times the square root of the number of words.

Training is a Spark aggregation over a bounded sample of the labelled rows: about
``sample_per_language`` texts of each language, those with the smallest hash of
their key.  Grams seen once in the sample are left out.  The
model is one table of hashes and one matrix of log frequencies, no larger than
the sample, and is sent to the tasks as a broadcast variable.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so is
every text when nothing was learned (no labelled row).  Ties go to the
alphabetically first language.  Repeated rows and further columns change nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlab.llm.common import as_long, mix64, slices, span_hashes
from playlab.session import ship_package, write_stage

MAX_GRAM = 4
SAMPLE_PER_LANGUAGE = 1500
SMOOTHING = 0.5
UNKNOWN = "und"
_SLICE = 1 << 18  # characters handled at once


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point: is it a letter (category L)?"""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


class Letters:
    """Words of some texts as spans over one array of code points."""

    def __init__(self, texts):
        low = [(t or "").lower() for t in texts]
        sizes = np.fromiter((len(t) for t in low), np.int64, len(low))
        cps = np.frombuffer((" " + " ".join(low) + " " * (MAX_GRAM + 1)).encode("utf-32-le"), np.uint32)
        letter = _letters()[cps]
        edges = np.diff(letter.astype(np.int8))
        self.cps = np.where(letter, cps, np.uint32(0)).astype(np.uint64)
        self.starts = np.flatnonzero(edges == 1) + 1
        self.ends = np.flatnonzero(edges == -1) + 1
        doc_start = np.zeros(len(low) + 1, np.int64)
        np.cumsum(sizes + 1, out=doc_start[1:])
        self.doc = np.searchsorted(doc_start + 1, self.starts, side="right") - 1
        self.hashes = span_hashes(self.cps, self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)

    def gram_positions(self, words: np.ndarray):
        """(position, word) of the n-gram starts of the given words: the mark before, then each letter."""
        size = self.ends[words] - self.starts[words] + 1
        owner = np.repeat(np.arange(len(words)), size)
        first = np.repeat(self.starts[words] - 1 - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return first + np.arange(len(owner)), owner

    def gram_hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        h = np.full(len(at), n, np.uint64)
        for i in range(n):
            h = mix64(h * np.uint64(31) + self.cps[at + i])
        return h


class Model:
    def __init__(self, langs: list[str], hashes: np.ndarray, logp: np.ndarray, floor: np.ndarray):
        self.langs, self.hashes, self.logp, self.floor = langs, hashes, logp, floor

    def find(self, h: np.ndarray):
        """Index into the table, and whether the hash is in it."""
        i = np.searchsorted(self.hashes, h)
        i[i == len(self.hashes)] = 0
        return i, (self.hashes[i] == h) if len(self.hashes) else np.zeros(len(h), bool)

    def predict(self, texts):
        """Per text: (language, score)."""
        w = Letters(texts)
        n = len(texts)
        if not self.langs or not len(w.starts):
            return [(UNKNOWN, 0.0)] * n
        row, known = self.find(w.hashes)
        scores = self.logp[row]
        unseen = np.flatnonzero(~known)
        if len(unseen):
            at, owner = w.gram_positions(unseen)
            gram_score = np.tile(self.floor, (len(at), 1))
            open_ = np.arange(len(at))
            for size in range(MAX_GRAM, 0, -1):
                i, hit = self.find(w.gram_hashes(at[open_], size))
                gram_score[open_[hit]] = self.logp[i[hit]]
                open_ = open_[~hit]
            for k in range(len(self.langs)):
                # mean over the word's positions: an unseen word weighs as one word
                total = np.bincount(owner, gram_score[:, k], len(unseen))
                scores[unseen, k] = total / np.bincount(owner, minlength=len(unseen))
        words = np.bincount(w.doc, minlength=n)
        sums = np.stack([np.bincount(w.doc, scores[:, k], n) for k in range(len(self.langs))], axis=1)
        best = np.argmax(sums, axis=1)
        scaled = sums / np.sqrt(np.maximum(words, 1))[:, None]
        p = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        p = p[np.arange(n), best] / p.sum(axis=1)
        return [(self.langs[b], float(s)) if m else (UNKNOWN, 0.0) for b, s, m in zip(best, p, words)]


def train(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id",
          sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn word and n-gram frequencies per language from a bounded, hash-chosen sample."""
    ship_package(docs.sparkSession)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    langs = sorted(sizes)
    share = F.create_map(*[F.lit(x) for l in langs for x in (l, min(1.0, sample_per_language / sizes[l]))])
    drawn = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(drawn < share[F.col(lang)]).select(lang, text)

    def count(batches):
        for batch in batches:
            langs_, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in slices([len(t) for t in texts], _SLICE):
                w = Letters(texts[i:j])
                which = {l: k for k, l in enumerate(sorted(set(langs_[i:j])))}
                doc_lang = np.fromiter((which[l] for l in langs_[i:j]), np.int64, j - i)
                word_lang = doc_lang[w.doc]
                at, owner = w.gram_positions(np.arange(len(w.starts)))
                parts = [(0, w.hashes, word_lang)]
                parts += [(n, w.gram_hashes(at, n), word_lang[owner]) for n in range(1, MAX_GRAM + 1)]
                for size, h, l in parts:
                    for name, k in which.items():
                        u, c = np.unique(h[l == k], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(u), pa.string()), pa.array(np.full(len(u), size, np.int32)),
                             pa.array(as_long(u)), pa.array(c.astype(np.int64))], names=["lang", "size", "gram", "n"])

    grams = (sample.mapInArrow(count, "lang string, size int, gram long, n long")
             .groupBy("size", "gram")
             .agg(*[F.sum(F.when(F.col("lang") == l, F.col("n"))).alias(f"n{k}") for k, l in enumerate(langs)],
                  F.sum("n").alias("total"))
             .where("total >= 2").drop("total"))
    t = write_stage(grams, "language-grams").toPandas()
    size = t["size"].to_numpy()
    counts = t[[f"n{k}" for k in range(len(langs))]].fillna(0).to_numpy(np.float64)
    logp = np.zeros_like(counts)
    floor = np.zeros(len(langs))
    for n in range(MAX_GRAM + 1):
        pick = size == n
        c = counts[pick] + SMOOTHING
        if len(c):
            logp[pick] = np.log(c / c.sum(axis=0))
            if n == 1:
                floor = np.log(SMOOTHING / c.sum(axis=0))
    hashes = t["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes, kind="stable")
    return Model(langs, hashes[order], logp[order].astype(np.float32), floor.astype(np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``lang_score`` added; any earlier columns of these names go."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values, found = list(texts), []
            for i, j in slices([len(t or "") for t in values], _SLICE):
                found += shared.value.predict(values[i:j])
            yield pd.DataFrame({"lang_pred": [f[0] for f in found], "lang_score": [f[1] for f in found]})

    predict = predict.asNondeterministic()  # else a filter on its result would run it a second time
    docs = docs.drop("lang_pred", "lang_score")
    found = F.col("__language")
    return (docs.withColumn("__language", predict(F.col(text)))
            .select(*[F.col(f"`{c}`") for c in docs.columns], found.lang_pred.alias("lang_pred"),
                    found.lang_score.alias("lang_score")))


def held_out(key: str = "doc_id") -> Column:
    """One row in four, by the checksum of its key as text; these are never trained on."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
