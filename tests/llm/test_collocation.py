"""Phrase collocations against brute force, with odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from playlab.llm.collocation import collocations, frequent_prefixes, tokens

DOCS = "doc_id long, text string, lang string, n int, phrase string"


def brute(rows, max_words, least, share, top):
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for s in range(1, max_words + 1):
                for i in range(len(w) - s + 1):
                    f[lang, tuple(w[i:i + s])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, p), a in candidates.items():
        for s in range(2, len(p)):
            for i in range(len(p) - s + 1):
                inside[lang, p[i:i + s]] = max(inside[lang, p[i:i + s]], a)
    out = {}
    for (lang, p), a in candidates.items():
        if 100 * inside[lang, p] >= share * a:
            continue
        score, _, l, r = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        out.setdefault(lang, []).append((" ".join(p), a, l, r, total[lang], score))
    rows = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        rows += [(lang, i, *x) for i, x in enumerate(found[:top], 1)]
    return sorted(rows)


def texts():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["é", "中", "a-b", "W3", "x y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(300):
        w = rng.choices(words, weights, k=rng.randint(0, 60))
        if i % 3 == 0:
            w[5:5] = ["hot", "pair"] + rng.choices(words, k=3)
        if i % 5 == 0:
            w += "one passage that is always the same".split()
        rows.append((i, "".join(x + rng.choice([" ", " ", " ", "\t ", ", ", ".\n", " ! "]) for x in w), rng.choice(["en", "en", "de", None])))
    return rows + [(300, None, "en"), (301, "", "en"), (302, " .,; ", "fr"), (303, "Hot pair", "und"), (5, rows[5][1], rows[5][2]),
                   (304, "the same " * 2000, "en"), (None, "no id\x00 here", "de")]


@pytest.mark.parametrize("most, share, top", [(4_000_000, 100, 2000), (150, 60, 7), (20, 100, 2000)])
def test_against_brute_force(spark, most, share, top):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS).repartition(3)
    got = collocations(docs, least=4, share=share, top=top, most=most).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, 4, share, top)


def test_products_beyond_64_bits(spark):
    """Scores stay exact where 1000 a n passes 64 bits (counts multiplied as decimals)."""
    rows = [(i, "big pair " * 400, "en") for i in range(40)]
    got = collocations(spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS), max_words=2, least=1).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 1, 100, 2000)
    row = spark.sql("select (cast(9e12 as decimal(20,0)) * cast(8e12 as decimal(20,0)) * cast(1000 as decimal(5,0))) "
                    "div (cast(3e12 as decimal(20,0)) * cast(7e12 as decimal(20,0))) as s").first()
    assert row.s == 1000 * 9 * 8 // 21


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(2)
    columns = rng.integers(0, 4, (3, 500))
    columns[1][columns[0] == 0] = 0
    columns[2][columns[1] == 0] = 0
    weight = rng.integers(1, 4, 500)
    want = Counter()
    for i in range(500):
        for k in range(1, 4):
            if columns[k - 1, i]:
                want[tuple(columns[:k, i])] += int(weight[i])
    got = {tuple(columns[:k, i]): n for i, k, n in frequent_prefixes(columns, weight, 20, 1)}
    assert got == {p: n for p, n in want.items() if n >= 20}


def test_tokens():
    ids, words = tokens("One two.\r\nTHREE\tone;".encode())
    assert [words[i] for i in ids] == [b"one", b"two", b"\xff", b"\xff", b"\xff", b"three", b"one", b"\xff", b"\xff"]
