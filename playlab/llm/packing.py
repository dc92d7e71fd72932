"""Mixture-controlled packing of documents into fixed-length sequences (operator 1).

Every source is a queue of tokens.  The packed stream is cut into windows of
``sequences_per_window`` sequences, and deficit round-robin fills each window:
a queue earns ``share * window`` tokens of credit per window, is served the whole
tokens of its credit, and carries the rest (its deficit, always below one token
either way) into the next window.  With shares c_1..c_j summed in queue order,
the queues up to j have been served ``floor(c_j * x)`` tokens after x stream tokens,
so the state of every queue at any window follows from x alone.  No task needs
the windows before its own: deficits are carried across windows and partitions
by arithmetic, and nothing is shuffled but the token totals per partition and source.

When a queue runs dry, its credit goes to the others (a new phase with new
shares); a queue's last tokens, at most two, are served at the phase's end.

Jobs: (1) tokenize once and write ids with their place in the partition's own
queue; (2) sum tokens per (partition, source), and by prefix sums place the
partition in the source's queue; (3) cut the documents of each partition at
the window and sequence borders.

Edge cases: null or empty text is a document of the end id alone; a null source
is a queue of its own; rows with the same or null doc_id are documents of their
own; an empty table gives no pieces; further columns are ignored.  Which sequence a
document comes to depends on how the table's files are split into tasks, since a
queue's order is that of its partitions; a rerun of lost tasks reads what job (1) wrote.
A tokenizer file of another layout raises ValueError before anything is read.
"""

from __future__ import annotations

import bisect
import json
import math
import struct
from fractions import Fraction

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlab.llm.bpe import byte_alphabet
from playlab.llm.common import slices
from playlab.session import ship_package, write_stage

TEMPER = 0.7               # target proportions: token counts to this power
SEQUENCES_PER_WINDOW = 64  # wide enough that most documents lie in a window uncut
CACHE_WORDS = 200_000  # encodings in a generation of a Python worker's cache, which keeps two

# The tokenizer's white space (\s) and its pieces of a word.
_SPLIT = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_PIECES_OF_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Signs of which any run is one piece.
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum())
# What str.split() cuts at and that white space does not hold.
_CONTROL = regex.compile(r"[\x1c-\x1f]")
# Words of these characters go straight to the model; others through the whole tokenizer.
_LATIN = regex.compile(r"[\x21-\x7e\xa1-\u017f]+")
# The layout of a tokenizer file that the encoder stands for.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class WordEncoder(dict):
    """Encodings by word, for a tokenizer that never joins across white space.

    A word that is looked up first is normalized and cut into pieces; new pieces go to
    the model of the tokenizers library, so words that differ in case or in the signs
    around them share its work.  A word outside Latin letters or with a special token's
    string goes through the library's whole tokenizer.

    A piece is encoded as the word it would be alone, so one cache keeps both, in two generations: a full
    younger one becomes the older one, whose entries come back when they are met again.
    So frequent words stay, and at most twice ``CACHE_WORDS`` entries take memory.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            check_layout(json.load(f), path)
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.model, self.older = self.tok.model, {}
        special = [regex.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(special) or r"(?!)")
        self.bytes_as = {b: c for c, b in byte_alphabet().items()}
        size = max(self.tok.get_vocab(with_added_tokens=True).values()) + 1
        self.kind = "H" if size <= 65536 else "I"
        self.packers = [struct.Struct(f"<{n}{self.kind}").pack for n in range(64)]

    def pack(self, ids) -> bytes:
        return self.packers[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}{self.kind}", *ids)

    def _model(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.bytes_as)
        return self.pack([t.id for t in self.model.tokenize(raw)])

    def _encode(self, word: str) -> bytes:
        if word.isascii():
            low = word.lower()
            core = low.rstrip(_SIGNS)
            if core.isalpha():  # holds no special token's string: those have a sign before a letter
                if len(core) < len(low):
                    return self[core] + self[low[len(core):]]
                return self._model(word) if low == word else self[low]
        if not _LATIN.fullmatch(word) or self.special.search(word):
            return self.pack(self.tok.encode(word, add_special_tokens=False).ids)
        low = word.lower()
        core = low.rstrip(_SIGNS)
        pieces = (core, low[len(core):]) if core.isalpha() else _PIECES_OF_WORD.findall(low)
        return b"".join([self._model(p) if p == word or self.special.search(p) else self[p] for p in pieces if p])

    def __missing__(self, word: str) -> bytes:
        code = self.older.get(word)
        if code is None:
            code = self._encode(word)
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = code
        return code

    def encode(self, texts: list[str]) -> list[bytes]:
        get, out = self.__getitem__, []
        for t in texts:
            words = [w for w in _SPLIT.split(t) if w] if _CONTROL.search(t) else t.split()
            out.append(b"".join(map(get, words)))
        return out


def check_layout(spec: dict, path: str) -> None:
    """Raise unless the file's tokenizer cuts words as ``WordEncoder`` does."""
    model = spec["model"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk",
                                            "byte_fallback", "ignore_merges"))
    added = all(not any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))
                and regex.match(r"[^\s\p{L}\p{N}].*\p{L}", t["content"]) for t in spec["added_tokens"])
    if (spec["normalizer"], spec["pre_tokenizer"]) != (_NORMALIZER, _PRE_TOKENIZER) \
            or model.get("type") != "BPE" or not model.get("end_of_word_suffix") or not plain or not added:
        raise ValueError(f"{path}: packing needs a lower-casing BPE tokenizer of single words with word ends")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker: later tasks find the words of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def schedule(totals: list[int], weights: list[Fraction]) -> list[tuple[int, list[int], list[int], int, int]]:
    """Phases (stream start, tokens served before per queue, cumulative shares as
    numerators of one denominator, that denominator, length)."""
    left, served, at, phases = list(totals), [0] * len(totals), 0, []

    def run(shares: list[Fraction], x: int):
        nonlocal at
        cum, acc = [Fraction(0)], Fraction(0)
        for s in shares:
            acc += s
            cum.append(acc)
        den = math.lcm(*(c.denominator for c in cum))
        phases.append((at, list(served), [c.numerator * (den // c.denominator) for c in cum], den, x))
        for j in range(len(left)):
            n = math.floor(cum[j + 1] * x) - math.floor(cum[j] * x)
            served[j] += n
            left[j] -= n
        at += x

    def over(shares, x):
        cum = Fraction(0)
        for j, s in enumerate(shares):
            nxt = cum + s
            if math.floor(nxt * x) - math.floor(cum * x) > left[j]:
                return True
            cum = nxt
        return False

    while any(left):
        active = [j for j, n in enumerate(left) if n]
        w = {j: weights[j] for j in active}
        if not any(w.values()):  # only queues without a weight are left: by what they hold
            w = {j: Fraction(left[j]) for j in active}
        total = sum(w.values())
        shares = [w.get(j, Fraction(0)) / total for j in range(len(left))]
        dry = min((j for j in active if shares[j]), key=lambda j: Fraction(left[j]) / shares[j])
        x = math.floor(Fraction(left[dry]) / shares[dry])
        while x and over(shares, x):
            x -= 1
        if x:
            run(shares, x)
        if left[dry]:  # the last tokens of the queue that runs dry
            run([Fraction(int(j == dry)) for j in range(len(left))], left[dry])
    return phases


class Placer:
    """Where the tokens of one queue go in the packed stream."""

    def __init__(self, phases, queue: int, window: int, length: int):
        self.window, self.length, self.queue = window, length, queue
        self.phases = [p for p in phases if p[2][queue + 1] > p[2][queue]]
        self.before = [p[1][queue] for p in self.phases]

    def pieces(self, first: int, n: int):
        """(start, length, sequence, offset) for n tokens that begin at ``first`` in the queue."""
        pos, end = first, first + n
        while pos < end:
            at, served, cum, den, size = self.phases[bisect.bisect_right(self.before, pos) - 1]
            lo, hi, done = cum[self.queue], cum[self.queue + 1], served[self.queue]
            # last window border at which no more than pos is served, then the next one
            guess = (pos - done) * den // (hi - lo)
            border = max(0, ((at + guess) // self.window - 1) * self.window - at)
            while True:
                nxt = min(size, ((at + border) // self.window + 1) * self.window - at)
                upto = done + hi * nxt // den - lo * nxt // den
                if upto > pos or nxt == size:
                    break
                border = nxt
            since = done + hi * border // den - lo * border // den
            stream = at + border + lo * nxt // den - lo * border // den + pos - since
            take = min(end, upto) - pos
            while take:
                seq, off = divmod(stream, self.length)
                m = min(take, self.length - off)
                yield pos - first, m, seq, off
                pos, stream, take = pos + m, stream + m, take - m


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 4096, weights: dict | None = None,
         temper: float = TEMPER, sequences_per_window: int = SEQUENCES_PER_WINDOW, source: str = "source") -> DataFrame:
    """Pieces (doc_id, source, start, length, doc_tokens, sequence_id, offset, ids).

    ``weights``: target token proportions per source (None as key: null source);
    without them a source with n tokens weighs ``n ** temper``: below 1, small sources
    get more than their share until they run dry; 1 keeps the corpus's own mixture.
    Sources without a weight follow when the others are dry.
    ``ids`` are little-endian unsigned 32-bit numbers.  One sequence at most is
    shorter than ``length``.  The driver holds one total per source.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer, encoding="utf-8") as f:
        check_layout(json.load(f), tokenizer)
    queue = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))

    def tokenize(batches):
        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker left there
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = enc.pack([end_id])
        at: dict[str, int] = {}
        for batch in batches:
            ids_, texts, queues = (batch.column(i).to_pylist() for i in range(3))
            for i, j in slices([len(t or "") for t in texts]):
                rows = []
                for d, q, e in zip(ids_[i:j], queues[i:j], enc.encode([t or "" for t in texts[i:j]])):
                    e += end
                    p, n = at.get(q, 0), len(e) // len(end)
                    at[q] = p + n
                    rows.append((part, q, d, p, n, e))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _TOKENS)], names=_TOKEN_NAMES)

    tokens = write_stage(
        docs.select("doc_id", "text", queue.alias("queue")).mapInArrow(
            tokenize, "part int, queue string, doc_id long, pos long, n long, ids binary"), "pack-tokens")
    sums = tokens.groupBy("part", "queue").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = write_stage(sums.select("part", "queue", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
                        "pack-bases")
    totals = {r.queue: r.n for r in bases.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    names = sorted(totals)
    key = {("null" if k is None else f"={k}"): Fraction(v) for k, v in (weights or {}).items()}
    shares = [key.get(q, Fraction(0)) if weights else Fraction(round(totals[q] ** temper)) for q in names]
    phases = schedule([totals[q] for q in names], shares)

    def cut(batches):
        pa.default_memory_pool().release_unused()
        placers = {q: Placer(phases, j, length * sequences_per_window, length) for j, q in enumerate(names)}
        for batch in batches:
            q_, d_, pos_, n_, ids_ = (batch.column(i) for i in range(5))
            rows, held = [], 0
            for q, d, pos, n, raw in zip(*(c.to_pylist() for c in (q_, d_, pos_, n_, ids_))):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                src = None if q == "null" else q[1:]
                for start, m, seq, off in placers[q].pieces(pos, n):
                    rows.append((d, src, start, m, n, seq, off, ids[start:start + m].tobytes()))
                held += n
                if held > 1 << 19:
                    yield _pieces(rows)
                    rows, held = [], 0
            if rows:
                yield _pieces(rows)

    return (tokens.join(bases.select("part", "queue", "base"), ["part", "queue"])
            .select("queue", "doc_id", (F.col("pos") + F.col("base")).alias("pos"), "n", "ids")
            .mapInArrow(cut, "doc_id long, source string, start long, length long, doc_tokens long, "
                             "sequence_id long, offset long, ids binary"))


_TOKEN_NAMES = ["part", "queue", "doc_id", "pos", "n", "ids"]
_TOKENS = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_PIECE_NAMES = ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
_PIECES = [pa.int64(), pa.string()] + [pa.int64()] * 5 + [pa.binary()]


def _pieces(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECES)], names=_PIECE_NAMES)
