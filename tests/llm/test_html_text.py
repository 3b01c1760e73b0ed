import html
import re

import pytest

from panelkit.llm.html_text import Weights, best_region, extract, extracted_pages, fit, main_text

SCHEMA = "page_id long, url string, html string, id string, text string, n_chars string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def article_of(source):
    """The article of the driver's pages, which hold it in one element of plain blocks."""
    inside = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br|article)\b[^>]*>", inside)
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
    return "\n".join(filter(None, lines))


def test_driver_pages(spark, sample):
    rows = [(r["page_id"], r["url"], r["html"]) for r in sample("pages")]
    got = {r.page_id: r for r in extracted_pages(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, url, source in rows:
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, article_of(source), len(article_of(source)))


OTHER = [
    ("<body><header><h1>Site</h1><nav><a>x</a></nav></header><div class='content'><h2>Hi &amp; you</h2><p>This is the  first para&nbsp;graph with many words.<p>A <a>link</a> here and quite a few words.<div class=ad-box>Buy now</div><p>third one of the text</p><form><input><p>Name</form></div><div id=comments><p>nice post really good stuff</div><footer>&copy; x</footer>",
     "Hi & you\nThis is the first para graph with many words.\nA link here and quite a few words.\nthird one of the text"),
    (
        "<article><h1>T</h1>one<br>two<aside>no</aside><section class='reader-comments'><article class=comment>bad</article></section> three</article><div class='cookie-notice'><p>we use cookies</p></div>",
        "T\none\ntwo\nthree"
    ),
    (
        "<main><div class=sidebar>links</div><p>yes <script>var t='</p>'</script>it<style>p{}</style> is</main>",
        "yes it is"
    ),
    ("plain text, no tags", "plain text, no tags"), ("<p>open <b>bold & <i>it", "open bold & it"), (
        "<<>< a < b and 3 > 2", "<<>< a < b and 3 > 2"
    ),
    ("<a title=\"x>y\">t</a>", "t"), ("", ""), ("<!-- open", ""), ("<script>never closed", ""), (
        "<p>a few words</p\n><p>and b<", "a few words\nand b<"
    ), ("&lt;p&gt; &#233;&#x41;", "<p> éA"),
]


@pytest.mark.parametrize("source, wanted", OTHER)
def test_other_pages(source, wanted):
    assert main_text(source, Weights()) == wanted


def test_best_region_as_brute_force():
    import random

    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(0, 9)
        scores, tags = [rng.randint(-5, 5) for _ in range(n)], [-rng.randint(0, 3) for _ in range(n)]
        worth = lambda a, b: sum(scores[a : b + 1]) + sum(tags[a + 1 : b + 1])  # noqa: B023, E731
        best = max((worth(a, b) for a in range(n) for b in range(a, n)), default=0)
        got = best_region(scores, tags)
        assert (got is None) == (best <= 0)
        assert got is None or worth(*got) == best


def test_weights_are_learned_from_labelled_pages(spark):
    labelled = [
        (
            i,
            "u",
            "<body><div class='zap'>" + "menu word " * 9 + "</div><article><p>" + "good text " * 20 + "</p></article></body>"
        ) for i in range(20)
    ]
    weights = fit(pages(spark, labelled))
    assert weights.by_feature["p"] > 0 > weights.by_feature[".zap"] and weights.tag < 0
    page = "<body><div class='zap'>" + "menu word " * 9 + "</div><div><p>" + "good text " * 20 + "</p></div></body>"
    assert main_text(page, weights) == ("good text " * 20).strip()


def test_odd_rows(spark):
    rows = [
        (1, None, None),
        (1, None, None),
        (None, "u", "<p>x</p>"),
        (2, "v", "<article>" + "<p>long words here</p>" * 20_000 + "</article>"),
        (3, "w", "<div>" * 3000 + "deep" + "</div>" * 10)
    ]
    got = {(r.page_id, r.url): r for r in extract(pages(spark, rows), Weights()).collect()}
    assert got[(1, None)].text == "" and got[(1, None)].n_chars == 0
    assert got[(None, "u")].text == "x"
    assert got[(2, "v")].text.count("\n") == 19_999
    assert got[(3, "w")].text == "deep"
    assert extracted_pages(pages(spark, [])).count() == 0
    assert extract(pages(spark, rows), Weights()).count() == 5
