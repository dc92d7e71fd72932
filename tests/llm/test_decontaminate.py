"""Benchmark decontamination against brute force, with odd rows."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playlab.llm.decontaminate import WuManber, decontaminate, merged

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, spans string, `odd.name` int"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, window=10):
    pairs = set()
    for item, text in bench:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            pairs.add(("" if item is None else str(item), tuple(w[i:i + window])))
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for item, p in pairs:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    items.add(item)
        out.append((doc, len(w), len(hit), sorted(items), bool(hit)))
    return out


def tables(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "Straße", "a", "longerword" * 4, "ŉ7"]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    bench = [(i, " ".join(say(rng.choice([1, 3, 9, 10, 11, 40])) + [f"item{i}"])) for i in range(40)]
    bench += [(40, None), (41, "... !"), (42, ""), (None, "null id"), (43, bench[5][1]), (43, bench[6][1]), (44, "x" * 5000 + " y")]
    docs = [(i, " ".join(say(rng.randint(1, 80)))) for i in range(80)]
    for i in range(80, 140):
        text = rng.choice(bench)[1] or ""
        docs.append((i, " ".join(say(rng.randint(0, 30))) + "\n-" + text.upper().replace(" ", ", ") + "; " + " ".join(say(5))))
    docs += [(140, None), (141, ""), (142, "?!\n"), (143, "Null ID"), (144, "nullid"), (7, docs[7][1]), (None, docs[90][1]),
             (145, " ".join(say(30000)) + " " + bench[8][1]), (146, "x" * 5000 + " Y"), (147, "x" * 4999 + " y")]
    return docs, bench


@pytest.mark.parametrize("shard_bytes", [32 << 20, 60_000])
def test_against_brute_force(spark, shard_bytes):
    docs, bench = tables()
    got = decontaminate(spark.createDataFrame([(i, t, "s", 7) for i, t in docs], DOCS).repartition(3),
                        spark.createDataFrame(bench, "item_id long, text string"), shard_bytes=shard_bytes).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got]
    assert sorted(rows, key=str) == sorted(brute(docs, bench), key=str)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit and r["odd.name"] == 7 for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words", "s", 7)], DOCS)
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert decontaminate(docs, bench.limit(0)).first().contaminated is False
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench).first().contaminated is True


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=20).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=20),
       st.binary(max_size=3000).map(lambda b: bytes(97 + x % 3 for x in b)))
def test_search_finds_every_occurrence(patterns, data):
    got = sorted((p, size) for p, size, _ in WuManber(dict.fromkeys(patterns, 1)).search(data))
    want = sorted((m, len(p)) for p in set(patterns) for m in range(len(data)) if data.startswith(p, m))
    assert got == want


def test_merged():
    assert merged([(5, 7), (0, 2), (2, 3), (6, 9)]) == [(0, 3), (5, 9)]
