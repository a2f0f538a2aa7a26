import itertools
import random

import numpy as np
import pytest

from folio.llm import html_extract as H


def test_minimum_cut_equals_brute_force():
    random.seed(4)
    for _ in range(300):
        n = random.randint(1, 8)
        gain = np.array([random.choice([-2, -1, -0.5, 0.5, 1, 2.5]) + random.random() / 10
                         for _ in range(n)])
        edges = {(i, j): random.random() for i in range(n) for j in range(i + 1, n)
                 if random.random() < 0.5}

        def cost(label):
            return (sum(-g if x else 0 for g, x in zip(gain, label))
                    + sum(w for (i, j), w in edges.items() if label[i] != label[j]))

        got = H.min_cut(gain, edges).tolist()
        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert cost(got) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var a="</p>";</script></head><body><header><h1>Site</h1><a href="/">Home</a></header>
<nav><ul><li><a href="/a?x=1>2">One</a><li><a href=/b>Two</a></ul></nav>
<div id='cookie-notice'><p>We use cookies, as everyone does, to serve you well.</p></div>
<article><h2>Title &amp; more</h2><p>First   paragraph,&nbsp;with <b>bold</b>
words &#233; &eacute; in it.<p>Second one, left open, with a <a href=x>link</a>.
<div class="ad">Buy this now, it is a bargain, only today.</div>
<blockquote>A quote, well said.</blockquote></article>
<section class="comments"><p>Nice article, thank you for it, I liked it.</p></section>
<form><label>Name</label><input></form><footer>&copy; site</footer></body></html>"""


def test_article_without_menus_notices_adverts_comments_and_forms():
    assert H.main_text(PAGE) == (
        "Title & more\nFirst paragraph, with bold words é é in it.\n"
        "Second one, left open, with a link.\nA quote, well said.")


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "<script>x", "<!-- a", "<a href='",
                                  "<p>" * 3000, "&#0;&#xffffff;&bogus"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(H.main_text(page), str)


def test_rows_and_empty_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "u", ""),
            (3, "u", "<article>" + "<p>Some words, that go on.</p>" * 3000 + "</article>")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "page_id long, url string, html string, text string, x int")
    out = H.extract(pages).collect()
    assert sorted(r["n_chars"] for r in out)[:2] == [0, 0] and len(out) == 5
    assert {r["n_chars"] == len(r["text"]) for r in out} == {True}
    assert next(r for r in out if r["page_id"] == 3)["text"].count("\n") == 2999
    assert len({r["text"] for r in out if r["page_id"] == 1}) == 1
    assert H.extract(pages.limit(0)).count() == 0


def unnamed_page(rng):
    """(html, its article): divisions without telling tags, classes or ids."""
    words = "the of river stone winter market garden letters houses morning quiet walked over".split()

    def sentence(n):
        return " ".join(rng.choices(words, k=n)).capitalize() + "."

    body = [sentence(rng.randint(14, 60)) for _ in range(rng.randint(4, 8))]
    body.insert(rng.randint(1, len(body) - 1), "Quiet")
    menu = "".join(f'<div><a href="/{w}">{w}</a></div>' for w in rng.sample(words, 6))
    foot = "".join(f'<div><a href="/{w}">{w}</a> |</div>' for w in rng.sample(words, 4))
    page = (f'<html><body><div class="a1">{menu}</div><div class="a2">'
            + "".join(f'<div><a href="/q">{t}</a></div>' if t == "Quiet" else f"<div>{t}</div>"
                      for t in body) + f'</div><div class="a3">{foot}</div>')
    return page, "\n".join(body)


def test_pages_without_telling_names_are_told_by_shape_and_neighbours(spark):
    rng = random.Random(5)
    made = [unnamed_page(rng) for _ in range(60)]
    pages = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(made)],
                                  "page_id long, url string, html string")
    out = {r["page_id"]: r for r in H.extract(pages).collect()}
    assert all(out[i]["text"] == text for i, (_, text) in enumerate(made))
    # The linked word inside the article looks like the menu: its neighbours decide.
    assert sum(r["n_changed"] for r in out.values()) >= 30
    assert sum(r["n_open"] for r in out.values()) > sum(r["n_changed"] for r in out.values())


def test_labels_come_from_the_tree():
    blocks = H.blocks_of("<div><a href=x>menu</a></div><div><h1>T</h1><p>Long enough text.</p>"
                         "<p>More.</p><ul><li>deep</li></ul></div><p>foot</p>")
    told = H.labels(blocks)
    assert {blocks[i].text: v for i, v in told.items()} == {
        "menu": False, "Long enough text.": True, "More.": True, "foot": False}
    assert H.labels([]) == {}


def test_fitted_costs_keep_the_article_of_a_hinted_page(spark):
    other = PAGE.replace("Second one", "Another one")
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate([PAGE, other] * 20)],
                                  "page_id long, url string, html string")
    assert H.main_text(PAGE, H.fit(pages)) == H.main_text(PAGE)


def test_one_label_only_gives_the_default_costs(spark):
    pages = spark.createDataFrame([(1, "u", "<p>One block.</p>"), (2, "u", None)],
                                  "page_id long, url string, html string")
    assert H.fit(pages) is H.DEFAULT
