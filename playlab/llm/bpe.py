"""Byte-level BPE encoding by prefix-sharing trie traversal, and decoding (operator 10).

The distinct pieces (words with their leading space, as the pre-tokenizer cuts
them) of a slice of texts form a trie.  It is walked depth first, which for
sorted pieces means: keep the path of the piece before, drop what the next piece
does not share, and go on from there.  Every node holds one state, the *last
token* of the encoding of its prefix, and the depth before that token.  Since a
BPE encoding of ``prefix + token`` is the encoding of ``prefix`` followed by
``token`` exactly if ``token`` joins validly to the last token of ``prefix``, a
node's state follows from the states above it on its path.  Encodings of shared
prefixes are thus computed once; a piece's encoding is read off its node by
following the states back to the root.

Two tokens join validly if no merge across their border comes before the merges
inside them.  That is decided by moving up the border sides of both merge trees
in the order of merge ranks, and kept per pair.

A text is first cut before white space into chunks (a word with the marks around
it), at places where the pre-tokenizer cuts whatever stands beside them.  Arrow
finds the distinct chunks of a slice of texts and puts their ids together again;
only distinct chunks not met lately are cut into pieces and encoded.

Edge cases: null or empty text has no ids and decodes to the empty text; the
special token's string in a text is that token, as in the tokenizers library;
repeated rows and further columns change nothing.
"""

from __future__ import annotations

import json
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from playlab.llm.common import slices
from playlab.session import ship_package

SLICE = 4 << 20  # bytes of texts encoded at once; a longer text is a slice of its own
CACHE_ENTRIES = 200_000  # encodings of chunks, and of pieces, in each generation that a Python worker keeps
CACHE_KEY = 64  # bytes of a chunk or piece whose encoding is kept
CACHE_PAIRS = 1_000_000  # verdicts on token pairs
CACHE_TAILS = 100_000  # last bytes of prefixes, with the tokens that may end there
TAIL = 4  # that many

# Fixed value: the pre-tokenizer's pattern, with its white space spelled out.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")

_NEVER = 1 << 60

# Bytes that are ASCII white space, other ASCII bytes, and bytes that begin a character that is not white space
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ASCII_WORD = ~_SPACE
_ASCII_WORD[128:] = False
_WORD_START = ~_SPACE
_WORD_START[128:0xC3] = _WORD_START[0xE1:0xE4] = False  # U+0085, U+00A0, U+1680, U+2000 to U+3000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def chunk_starts(buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where texts and chunks start in the UTF-8 bytes of some texts, as flags; ``ends`` bounds the texts.

    The pre-tokenizer's pieces never hold white space after another character, so a text may be cut
    between such a character and white space; and before the last of several white spaces, as it cuts
    there too, if that is a space with a word after it.
    """
    flags = np.zeros(len(buf) + 1, bool)
    flags[:-2] = (buf[:-1] == 32) & _WORD_START[buf[1:]]
    flags[ends - 1] = False  # the next byte is of another text
    flags[1:-1] |= _SPACE[buf[1:]] & _ASCII_WORD[buf[:-1]]
    flags[ends] = True
    return flags


class Recent:
    """What was looked up or added lately: the newer of two generations, when full, replaces the older."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key: bytes):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.add({key: value})
        return value

    def add(self, entries: dict):
        for key, value in entries.items():
            if len(key) <= CACHE_KEY:
                if len(self.new) >= self.limit:
                    self.new, self.old = {}, self.new
                self.new[key] = value


class Decoder:
    def __init__(self, path: str):
        self._read(path)

    def _read(self, path: str) -> dict:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        return spec

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, tokens)).decode("utf-8", errors="replace")


class TrieEncoder(Decoder):
    def __init__(self, path: str):
        spec = self._read(path)
        vocab = spec["model"]["vocab"]
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b = vocab[left], vocab[right]
            self.rank[a, b] = r
            parts.setdefault(vocab[left + right], (a, b))
        # each token's border nodes from a byte up to the token, with the rank that
        # merges the node into the next one (_NEVER at the token itself)
        self.right_side: dict[int, list[tuple[int, int]]] = {}
        self.left_side: dict[int, list[tuple[int, int]]] = {}
        self.verdict: dict[int, bool] = {}
        self.token_of: dict[bytes, int] = {}
        singles = [i for t, i in vocab.items() if len(t) == 1]
        made = sorted(parts, key=lambda i: self.rank[parts[i]])
        for i in singles:
            self.right_side[i] = self.left_side[i] = [(i, _NEVER)]
            self.token_of[self.bytes_of[i]] = i
        for i in made:
            a, b = parts[i]
            if a not in self.right_side or b not in self.right_side:
                continue  # a part that no text is encoded to
            r = self.rank[a, b]
            if self._meets(a, b, r):
                self.right_side[i] = [*self.right_side[b][:-1], (b, r), (i, _NEVER)]
                self.left_side[i] = [*self.left_side[a][:-1], (a, r), (i, _NEVER)]
                self.token_of[self.bytes_of[i]] = i
        # lengths of the longer tokens that end in given bytes, longest first
        ending: dict[bytes, set[int]] = {}
        for t in self.token_of:
            if len(t) > TAIL:
                ending.setdefault(t[-TAIL:], set()).add(len(t))
        self.lengths = {k: sorted(v, reverse=True) for k, v in ending.items()}
        self.endings: dict[bytes, list[tuple[int, int]]] = {}
        self.known, self.pieces = Recent(CACHE_ENTRIES), Recent(CACHE_ENTRIES)
        self.special_ids = {s.encode(): np.array([i], "<u4").tobytes() for s, i in self.special.items()}

    def _meets(self, a: int, b: int, limit: int) -> bool:
        """No merge across the border of a and b comes before ``limit`` and the merges inside."""
        left, right, rank = self.right_side[a], self.left_side[b], self.rank
        i = j = 0
        while True:
            (x, up_x), (y, up_y) = left[i], right[j]
            across = rank.get((x, y), _NEVER)
            if across < up_x and across <= up_y and across < limit:
                return False
            if up_x == _NEVER and up_y == _NEVER:
                return True
            if up_x <= up_y:
                i += 1
            else:
                j += 1

    def _endings(self, tail: bytes) -> list[tuple[int, int]]:
        """(length, token) of the tokens that may end where ``tail`` ends, longest first; -1: look it up."""
        token_of = self.token_of
        found = [(k, -1) for k in self.lengths.get(tail, ())]
        found += [(k, token_of[tail[-k:]]) for k in range(len(tail), 0, -1) if tail[-k:] in token_of]
        self.endings[tail] = found
        return found

    def _encode_sorted(self, pieces: list[bytes]):
        """Yield the ids of each piece; the pieces come sorted, so the path is a trie's.

        A state on the path is found when a state below it asks for it (-1 until then).
        """
        token_of, endings, verdict, meets = self.token_of, self.endings, self.verdict, self._meets
        last, back = [-1], [0]  # the states on the path, by depth
        before = b""
        for piece in pieces:
            size = len(piece)
            depth, n = 0, min(len(before), size)
            while depth < n and before[depth] == piece[depth]:
                depth += 1
            last[depth + 1:] = back[depth + 1:] = [-1] * (size - depth)
            waiting = []  # states that wait for one above, with the token they try and those left to try
            d, tries, found = size, None, last[size] >= 0
            while not found:
                if tries is None:
                    tail = piece[d - TAIL if d > TAIL else 0:d]
                    tries = iter(endings.get(tail) or self._endings(tail))
                for k, t in tries:
                    if t < 0:
                        if k > d:
                            continue
                        t = token_of.get(piece[d - k:d], -1)
                        if t < 0:
                            continue
                    if k < d:
                        above = last[d - k]
                        if above < 0:
                            waiting.append((d, tries, k, t))
                            d, tries = d - k, None
                            break
                        pair = above << 32 | t
                        ok = verdict.get(pair)
                        if ok is None:
                            ok = verdict[pair] = meets(above, t, _NEVER)
                        if not ok:
                            continue
                    last[d], back[d] = t, d - k
                    found = True
                    break
                else:
                    raise ValueError(f"no token ends {piece[:d]!r}")
                while found and waiting:
                    above = last[d]
                    d, tries, k, t = waiting.pop()
                    pair = above << 32 | t
                    ok = verdict.get(pair)
                    if ok is None:
                        ok = verdict[pair] = meets(above, t, _NEVER)
                    if ok:
                        last[d], back[d] = t, d - k
                    else:
                        found = False
            ids, d = [], size
            while d:
                ids.append(last[d])
                d = back[d]
            ids.reverse()
            yield ids
            before = piece

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each piece."""
        if len(self.verdict) > CACHE_PAIRS:
            self.verdict.clear()
        if len(self.endings) > CACHE_TAILS:
            self.endings.clear()
        order = sorted(pieces)
        return {p: struct.pack(f"<{len(ids)}I", *ids) for p, ids in zip(order, self._encode_sorted(order))}

    def _cut_text(self, text: str) -> list[bytes]:
        """Pieces of a text, or of a chunk; special tokens are pieces of their own."""
        if self._cut and any(s in text for s in self.special):
            return [p.encode() for part in self._cut.split(text)
                    for p in ([part] if part in self.special else _PATTERN.findall(part))]
        return [p.encode() for p in _PATTERN.findall(text)]

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct chunks."""
        found = list(map(self.known.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        cut = [self._cut_text(chunks[i].decode()) for i in new]
        ids = dict(self.special_ids)
        for p in set(chain.from_iterable(cut)).difference(ids):
            ids[p] = self.pieces.get(p)
        fresh = self._learn([p for p, v in ids.items() if v is None])
        self.pieces.add(fresh)
        ids.update(fresh)
        for i, c in zip(new, cut):
            found[i] = b"".join(map(ids.__getitem__, c))
        self.known.add({chunks[i]: found[i] for i in new})
        return found

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit numbers; null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not pc.any(pc.not_equal(texts, "")).as_py():
            return pa.array([b""] * len(texts), pa.binary())
        data = texts.buffers()[2]
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        first = chunk_starts(np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0])
        for s in self.special:  # found in whole texts
            for i in np.flatnonzero(pc.match_substring(texts, s).to_numpy(zero_copy_only=False)):
                first[ends[i] - ends[0] + 1:ends[i + 1] - ends[0]] = False
        starts = (np.flatnonzero(first) + ends[0]).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), data])
        distinct = chunks.dictionary_encode()
        ids = pa.array(self._encode_chunks(distinct.dictionary.to_pylist()), pa.binary()).take(distinct.indices)
        bounds = np.frombuffer(ids.buffers()[1], np.int32)[np.searchsorted(starts, ends)]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(bounds), ids.buffers()[2]])

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TrieEncoder(path)
    return _ENCODERS[path]


_DECODERS: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids as little-endian unsigned 32-bit numbers; one row per row."""
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            for i, j in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), SLICE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), enc.encode_array(texts.slice(i, j - i))], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode(coded: DataFrame, vocabulary: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the texts that the ids stand for."""
    ship_package(coded.sparkSession)
    kind = coded.schema[key].dataType.simpleString()

    def run(batches):
        dec = decoder(vocabulary)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for i, j in slices([len(x or b"") for x in ids]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array([dec.decode(x or b"") for x in ids[i:j]], pa.string())], names=[key, "ids", "decoded"])

    return coded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, ids binary, decoded string")
