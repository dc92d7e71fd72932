"""Periodic runs against brute force, with odd rows."""

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from playlab.llm.periodic import find_runs, periodic_runs
from playlab.llm.queries import QUERIES

DOCS = "doc_id long, text string, runs int, `odd.name` string"


def brute(words, least=12):
    """Every stretch (start, length, smallest period) that is a run, by trying all periods."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=6), st.sampled_from([2, 3, 5, 12]))
def test_runs_of_small_alphabets(texts, least):
    first = np.cumsum([0] + [len(t) for t in texts])
    got = find_runs(np.array([w for t in texts for w in t], np.int64), first, least)
    want = [(s + int(f), length, q) for f, t in zip(first, texts) for s, length, q in brute(t, least)]
    assert sorted(got) == sorted(want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 7), st.integers(0, 5)), max_size=8), st.randoms())
def test_runs_of_planted_repeats(parts, rng):
    words = []
    for q, times, rest in parts:
        unit = [rng.randrange(4) for _ in range(q)]
        words += unit * times + unit[:rest] + [rng.randrange(30) for _ in range(rng.randrange(4))]
    assert sorted(find_runs(np.array(words, np.int64), np.array([0, len(words)]), 12)) == brute(words)


def rows():
    rng = random.Random(5)
    say = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    out = []
    for i in range(150):
        unit = say(rng.randint(1, 12))
        out.append((i, " ".join(say(rng.randint(0, 50)) + unit * rng.randint(1, 8) + say(rng.randint(0, 20)))))
    out += [(200, None), (201, ""), (202, " \n\t"), (203, "a " * 3000), (204, "a b " * 6), (205, "a b " * 12),
            (206, "\n".join(say(8) + ["the same closing line of eight words here"] * 3)), (7, out[7][1]), (None, out[9][1]),
            (207, " ".join(say(40000) * 3))]
    return out


def test_against_brute_force(spark):
    texts = rows()
    got = periodic_runs(spark.createDataFrame([(i, t, 1, "x") for i, t in texts], DOCS).repartition(3)).collect()
    want = []
    for i, t in texts:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = [(0, 120000, 40000)] if i == 207 else brute(words)
        want.append((i, runs, collapsed(words, runs)))
    have = [(r.doc_id, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert all(r["odd.name"] == "x" for r in got)


def test_query_rewrites_every_tenth_text(spark, tmp_path):
    texts = [(i, t) for i, t in rows() if i is not None] + [(i, " ".join(f"v{k % 57}" for k in range(i % 200))) for i in range(300, 500)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {}
    for r in QUERIES["op11_periodic"](spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in texts:
        words = (t or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        if i == 207:
            continue
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert all((r.n_runs, r.start, r.length, r.period) == (len(runs), *best) for r in got[i])
        assert all(r.exponent_milli == (1000 * best[1] // best[2] if runs else None) for r in got[i])


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
