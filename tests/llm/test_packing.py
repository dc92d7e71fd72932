"""Packing: ids as the tokenizers library's, gapless sequences, shares per window."""

import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playlab.llm import packing
from playlab.llm.queries import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def coder():
    return packing.WordEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("abzAZ'sStT 0½.,<|>\n\t\x1c\x85éÉßİΣſ日😀́ "), st.characters(codec="utf-8")),
                    max_size=60))
def test_ids_equal_the_library(text):
    enc = packing.encoder(PATH)
    want = enc.tok.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == want


def test_special_tokens(coder):
    for text in ("<|endoftext|> a<|startoftext|>b", "x<|endoftext|>", "< |endoftext|>"):
        assert np.frombuffer(coder.encode([text])[0], "<u2").tolist() == coder.tok.encode(text, add_special_tokens=False).ids


def test_cache_stays_bounded_within_a_text(monkeypatch):
    """One text of many words does not pass the bound, keeps its ids, and frequent words are encoded once."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    enc, most, encoded = packing.WordEncoder(PATH), 0, []
    one_word = enc._encode

    def watched(word):
        nonlocal most
        most = max(most, len(enc) + len(enc.older))
        encoded.append(word)
        return one_word(word)

    enc._encode = watched
    rare = [chr(97 + i // 676) + chr(97 + i // 26 % 26) + chr(97 + i % 26) + "x" for i in range(2000)]
    text = " ".join(w for r in rare for w in (r, "often", "Often,"))
    want = enc.tok.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == want
    assert 50 < most <= 100
    assert sorted(encoded) == sorted([*rare, "often", "Often,", ","])


@pytest.mark.parametrize("totals,weights", [
    ([50, 30, 20], [50, 30, 20]), ([1, 1000], [99, 1]), ([7], [1]), ([5, 0, 9], [1, 1, 1]), ([100, 100, 3], [1, 0, 2]),
])
def test_schedule_places_every_token_once(totals, weights):
    phases = packing.schedule(totals, [Fraction(w) for w in weights])
    seen = set()
    for j, n in enumerate(totals):
        if not n:
            continue
        placer = packing.Placer(phases, j, 8, 8)
        at = 0
        for first, size in ((0, n // 2), (n // 2, n - n // 2)):
            got = 0
            for start, m, seq, off in placer.pieces(first, size):
                assert start == got and off + m <= 8
                got += m
                seen.update(range(seq * 8 + off, seq * 8 + off + m))
            assert got == size
            at += size
    assert seen == set(range(sum(totals)))


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def check(docs, pieces, length):
    enc = packing.encoder(PATH)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for seq, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == length or seq == max(by_seq)
    for d, text in docs.items():
        ids = [*np.frombuffer(enc.encode([text or ""])[0], "<u2").tolist(), 2]
        whole = b"".join(bytes(p["ids"]) for p in sorted(by_doc[d], key=lambda p: p["start"]))
        assert whole == np.array(ids, "<u4").tobytes()
        assert {p["doc_tokens"] for p in by_doc[d]} == {len(ids)}


def test_pack_shares_and_edges(spark):
    docs = {i: f"word{i} and some more text of document {i} " * (i % 7) for i in range(300)}
    docs[300], docs[301] = None, ""
    rows = [(d, t, None if d % 50 == 0 else f"s{d % 3 if d % 4 else 0}", "x", 1) for d, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, queue string, part int").repartition(5)
    pieces = rows_of(packing.pack(df, PATH, length=64, temper=1, sequences_per_window=1))
    check(docs, pieces, 64)
    total = sum(p["length"] for p in pieces)
    share, per = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        share[p["source"]] += p["length"]
        per[p["sequence_id"]][p["source"]] += p["length"]
    for seq in list(per)[:-1]:
        if seq != max(per):
            for s, n in share.items():  # a deficit below one token is carried into and out of the window
                assert abs(per[seq][s] - 64 * n / total) < 2
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_pack_with_weights(spark):
    docs = {i: f"text {i} " * 20 for i in range(120)}
    df = spark.createDataFrame([(d, t, "a" if d % 4 else "b") for d, t in docs.items()],
                               "doc_id long, text string, source string").repartition(3)
    pieces = rows_of(packing.pack(df, PATH, length=64, weights={"a": 1, "b": 1}, sequences_per_window=1))
    check(docs, pieces, 64)
    assert_shares(pieces, {"a": Fraction(1, 2), "b": Fraction(1, 2)}, 1, 64)


def assert_shares(pieces, target, width, length):
    """Every window before the first queue runs dry holds the target proportions; each has a token either way."""
    per = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        per[p["sequence_id"] // width][p["source"]] += p["length"]
    full = min(max(w for w in per if per[w][s]) for s in target)
    assert full > 1
    for w in range(full):
        for s, share in target.items():
            assert abs(per[w][s] - share * width * length) < 2, (w, s)


def test_tempered_shares_in_every_window(spark):
    docs = {i: f"text {i} of some words " * (1 + i % 9) for i in range(400)}
    df = spark.createDataFrame([(d, t, "abc"[min(2, d % 7)]) for d, t in docs.items()],
                               "doc_id long, text string, source string").repartition(6)
    pieces = rows_of(packing.pack(df, PATH, length=64, temper=0.5, sequences_per_window=4))
    check(docs, pieces, 64)
    total = defaultdict(int)
    for p in pieces:
        total[p["source"]] += p["length"]
    weigh = {s: round(n ** 0.5) for s, n in total.items()}
    assert_shares(pieces, {s: Fraction(w, sum(weigh.values())) for s, w in weigh.items()}, 4, 64)


def test_wide_windows_leave_documents_whole(spark):
    rows = [(i, f"text {i} of some words " * 5, f"s{i % 9}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    pieces = rows_of(packing.pack(df, PATH, length=256, sequences_per_window=16))
    sequences = 1 + max(p["sequence_id"] for p in pieces)
    windows = -(-sequences // 16)
    assert len(pieces) <= len(rows) + sequences + 9 * (windows + 18)


def test_other_tokenizer_layouts_raise(spark):
    df = spark.createDataFrame([(1, "Some text", "a")], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="byte_bpe_50k"):
        packing.pack(df, tokenizer_file("byte_bpe_50k.json"))


def test_a_text_of_megabytes(spark):
    text = "some words, and Wörter 42 " * 80_000 + "x" * 300_000
    df = spark.createDataFrame([(1, text, "a"), (2, "short", None)], "doc_id long, text string, source string")
    check({1: text, 2: "short"}, rows_of(packing.pack(df, PATH)), 4096)


def test_query_checksums(spark):
    from playlab.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    enc = packing.encoder(PATH)
    got = QUERIES["op1_packing"](spark, d).collect()
    for r in got:
        ids = np.append(np.frombuffer(enc.encode([texts[r.doc_id]])[0], "<u2"), 2).astype("<u4")
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids)
