"""Cuts against all labellings; pages whose article is known."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from profilespark.llm import mincut, pages


def cost(pull, edges, side):
    return sum(abs(p) for p, s in zip(pull, side) if (p > 0) != s and p) + sum(c for u, v, c in edges if side[u] != side[v])


def test_cuts_are_the_smallest_of_all_labellings():
    draw = random.Random(2)
    for _ in range(400):
        n = draw.randint(1, 9)
        pull = [draw.randint(-6, 6) for _ in range(n)]
        edges = [(u, v, draw.randint(0, 4)) for u in range(n) for v in range(n) if draw.random() < 0.35]
        sides = [s for s in itertools.product((False, True), repeat=n)]
        least = min(cost(pull, edges, s) for s in sides)
        best = [s for s in sides if cost(pull, edges, s) == least]
        got = tuple(mincut.source_side(pull, edges))
        assert got in best
        # the smallest source side is part of every other one
        assert all(not g or s[i] for s in best for i, g in enumerate(got))


def test_flow_alone_gives_the_same_cut():
    draw = random.Random(5)
    for _ in range(100):
        n = draw.randint(2, 60)
        pull = [draw.randint(-5, 5) for _ in range(n)]
        edges = [(i, i + 1, draw.randint(1, 5)) for i in range(n - 1)] + [(draw.randrange(n), draw.randrange(n), 2) for _ in range(n)]
        edges = [e for e in edges if e[0] != e[1]]
        assert mincut.source_side(pull, edges) == mincut._by_flow(pull, edges)


#: (html, main text)
PAGES = [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<!-- never closed <p>text", ""), ("<script>var t='</p>'", ""),
    ("<article><h1>A &amp; B</h1><p>One\n  two &copy; <b>th</b>ree.<p>Four&nbsp;five.</article><footer>&copy; site</footer>", "A & B One two © three. Four five."),
    ("<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul><article><p>The menu above is never closed, but this is the text.</p></article>",
     "The menu above is never closed, but this is the text."),
    ("<body class='has-sidebar'><div class=ad>Buy now.</div><main><p>Long enough to be a text of the page, with a stop.</p><aside>See also</aside>"
     "<form><label>Mail</label><button>Go</button></form><p>Second.</p></main><section id=comments><h2>Comments</h2><article class=comment><p>I do not agree "
     "with any of this, and I say so at length.</p></article></section></body>", "Long enough to be a text of the page, with a stop. Second."),
    ("<div id='cookie-notice'>We use cookies.</div><article><div class=promo>Subscribe today!</div><p>Text <a href=x>with link</a> goes on.</p><script>x</script>"
     "<table><tr><td>1<td>2</table></article>", "Text with link goes on. 1 2"),
    ("<article><p>Attribute <span title='a > b'>quoted</span> and 3 < 4.</p><p hidden>Unseen.</p><p style='display: none'>Unseen.</p></article>",
     "Attribute quoted and 3 < 4."),
    ("<ARTICLE><P>Upper case.</P></ARTICLE><DIV CLASS=\"sideBar\">Left out.</DIV>", "Upper case."),
]


@pytest.fixture(scope="module")
def model():
    return pages.log_odds({})


@pytest.mark.parametrize("source, text", PAGES)
def test_known_pages(source, text, model):
    assert pages.main_text(source, model)[0] == text


def test_a_page_without_telling_elements(model):
    """Only the shape of the blocks and the smoothness of the cut tell text from menus."""
    sentence = "This is a paragraph of the article, which has more than a handful of words, and ends with a full stop."
    menu = "".join(f"<div><a href=/{i}>Link {i}</a></div>" for i in range(9))
    text = f"<div>{sentence}</div>" * 3 + "<div>Short.</div>" + f"<div>{sentence}</div>" * 3
    got = pages.main_text(f"<div>{menu}</div><div>{text}</div><div>{menu}</div>", model)[0]
    assert got == " ".join([sentence] * 3 + ["Short."] + [sentence] * 3)


def test_training_learns_from_blocks_that_speak_for_themselves(spark, model):
    rows = spark.createDataFrame([(h,) for h, _ in PAGES] * 40, "html string")
    fitted = pages.fit(rows)
    assert fitted["link=4"] < 0 < fitted["end=True"]
    assert fitted["tag=aside"] == -pages.FEATURE_COST
    assert pages.fit(rows.limit(0)) == model
    for source, text in PAGES:
        assert pages.main_text(source, fitted)[0] == text


def test_the_table(spark, model):
    rows = [(i, f"http://x/{i}", h) for i, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[6][0])] * 2
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"text": F.lit("x"), "page source": F.lit(1)})
    out = pages.extract(table, model)
    assert out.columns[:4] == ["page_id", "url", "text", "n_chars"]
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in out.collect())
    assert got == sorted((str(i), PAGES[6 if i is None else i][1], len(PAGES[6 if i is None else i][1])) for i, _, _ in rows)
    assert pages.extract(table.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="text"):
        pages.extract(table, model, keep=("page_id", "text"))


def test_a_very_long_and_a_very_deep_page(model):
    long = "<article>" + "<p>word word word.</p>" * 40000 + "</article><footer>x</footer>"
    assert pages.main_text(long, model)[2] == 40000
    deep = "<div>" * 20000 + "<p>Deep text of some words.</p>"
    assert pages.main_text(deep, model)[1] == 1
    undecided = "".join(f"<div>Some few words {'here.' if i % 3 else '<a>linked</a>'}</div>" for i in range(4000))
    assert pages.main_text(undecided, model)[1] == 4000
