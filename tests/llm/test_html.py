"""Main text of pages: parsing in linear time, Viterbi and weights against enumeration."""

import itertools
import math
import random
import time

import numpy as np
import pytest

from playlab.llm import html_text as H


def small_crf(rng):
    pages, labels = [], []
    for _ in range(6):
        n = rng.randint(1, 5)
        pages.append([(H.place(rng.choice([(("article", ()), ("p", ())), (("nav", ()), ("li", ())), (("div", ("ad",)),)])),
                       rng.choice(["Some words.", "Home", "x" * 50]), rng.choice([0.0, 1.0])) for _ in range(n)])
        labels.append([rng.randint(0, 1) for _ in range(n)])
    return H.Crf().fit(pages, labels, steps=20), pages, labels


def score(model, page, y):
    total = model.ends[0, y[0]] + model.ends[1, y[-1]]
    for t, block in enumerate(page):
        total += sum(model.w[f, y[t]] for f in model.features.block(block))
        total += model.pair[y[t - 1], y[t]] if t else 0.0
    return total


@pytest.mark.parametrize("seed", range(8))
def test_viterbi_against_all_labellings(seed):
    model, pages, _ = small_crf(random.Random(seed))
    for page in pages:
        best = max(score(model, page, y) for y in itertools.product((0, 1), repeat=len(page)))
        assert score(model, page, model.labels(page)) == pytest.approx(best, abs=1e-9)


def test_viterbi_ties_are_not_main_text():
    model, pages, _ = small_crf(random.Random(1))
    model.w, model.pair, model.ends = model.w * 0, model.pair * 0, model.ends * 0
    assert all(y == 0 for page in pages for y in model.labels(page))


@pytest.mark.parametrize("seed", range(3))
def test_fitting_raises_the_likelihood(seed):
    """Log likelihood by enumeration: more steps of the fit give a better one than none."""
    def likelihood(model, pages, labels):
        total = 0.0
        for page, y in zip(pages, labels):
            all_ = [score(model, page, z) for z in itertools.product((0, 1), repeat=len(page))]
            total += score(model, page, y) - (max(all_) + math.log(sum(math.exp(a - max(all_)) for a in all_)))
        return total

    model, pages, labels = small_crf(random.Random(seed))
    fitted = likelihood(model, pages, labels)
    model.w, model.pair, model.ends = model.w * 0, model.pair * 0, model.ends * 0
    plain = likelihood(model, pages, labels)
    assert plain == pytest.approx(-sum(map(len, pages)) * math.log(2))
    assert fitted > plain


def test_deep_and_broken_pages_take_linear_time():
    for page in ("<ul><li>x" * 100_000, "<div>" * 200_000 + "x" + "</div>" * 200_000, "</p>" * 300_000 + "x", "<a" * 300_000,
                 "".join(f"<t{i}>" for i in range(100_000)) + "x"):
        before = time.process_time()
        found = H.blocks(page)
        assert time.process_time() - before < 30
        assert len(found) == page.count("x") or page.startswith("<a")


def test_slash_at_the_end_of_a_tag():
    def texts(page):
        return [b[1] for b in H.blocks(page)]

    assert texts("<p>a<script src=x/>code()</script>b") == ["a", "b"]
    assert texts("<p>a<script src='x' />code()</script>b") == ["a", "b"]
    assert texts("x<svg/>y<svg><path/>q</svg>z") == ["x", "y", "z"]
    assert texts("a<br/>b<img src=i/>c") == ["a b", "c"]
    links = H.blocks("<p><a id=top/><a href=x>Home</a></p><p>Plain words</p>")
    assert [b[2] for b in links] == [1.0, 0.0]


def test_comments_and_cut_pages():
    def texts(page):
        return [b[1] for b in H.blocks(page)]

    assert texts("<p>a</p>b<!-- c > d") == ["a", "b"]
    assert texts("<p>a</p>b <!-- c") == ["a", "b"]
    assert texts("<p>a <!-- x --> b") == ["a b"]
    assert texts("1 < 2 and 3") == ["1 < 2 and 3"]
    assert texts("") == texts(None) == []


def test_places_follow_the_path():
    path = (("html", ()), ("body", ()), ("article", ()), ("div", ("comment",)), ("p", ()))
    at = H.place(path)
    assert (at.leaf, at.apart, at.inside, at.off) == ("p", True, True, True)
    assert H.markup_label(at) == 0 and H.markup_label(H.place(path[:3])) == 1
    assert H.markup_label(H.place((("header", ()), ("article", ())))) == 1


def test_unmarked_pages_do_not_teach(spark):
    """A table of marked pages and as many without any telling markup: the model is that of the marked ones."""
    say = lambda rng: " ".join(rng.choice("the quick brown fox jumps over lazy dogs".split()) for _ in range(30)) + "."
    marked, plain = [], []
    for i in range(30):
        rng = random.Random(i)
        inner = "".join(f"<p>{say(rng)}</p>" for _ in range(4))
        marked.append((i, f"<body><nav><a href=x>Home</a></nav><article>{inner}</article><footer>Rights</footer></body>"))
        plain.append((100 + i, f"<body><table><tr><td>{say(rng)}</td></tr></table></body>"))
    one = H.train(spark.createDataFrame(marked, "page_id long, html string"))
    both = H.train(spark.createDataFrame(marked + plain, "page_id long, html string"))
    assert one.w.shape == both.w.shape and np.allclose(one.w, both.w)
    assert H.train(spark.createDataFrame(plain, "page_id long, html string")).text("<main><p>x</main>y") == "x"


def test_a_page_of_megabytes(spark):
    page = "<body><main>" + "<p>Some words &amp; more.</p>" * 100_000 + "</main><footer>F</footer></body>"
    df = spark.createDataFrame([(1, page, "kept")], "page_id long, html string, text string")
    assert H.extract(df, H.Crf()).head().text == " ".join(["Some words & more."] * 100_000)
