"""Elements whose names usually mark other matter, around the article."""

import pytest

from panelkit.llm.html_text import Weights, main_text

TEXT = "<h1>A title</h1>" + "".join(f"<p>{'words of the article text ' * 9}</p>" for _ in range(8))
WANTED = main_text(f"<article>{TEXT}</article>", Weights())
NAV = "<nav><ul><li><a>one</a><li><a>two</a></ul></nav>"
AFTER = "<footer>all rights reserved</footer><div class=comments>" + "<p>very nice text of yours</p>" * 5 + "</div>"
WRAPPERS = [
    '<div class="layout has-sidebar">{}</div>', '<div id="page" class="no-sidebar">{}</div>', "<form><input>{}</form>",
    '<div class="notice">{}</div>', '<section class="social-policy">{}</section>',
    '<div class="search results page"><main>{}</main></div>', '<div class="with-ads"><article>{}</article></div>',
    "<form><div class=notice>{}</div></form>", "<aside><div class='article'>{}</div></aside>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrappers_keep_their_article(wrapper):
    assert main_text(f"<body><header><h2>Site</h2></header>{wrapper.format(TEXT)}</body>", Weights()) == WANTED
    assert main_text(f"<body>{wrapper.format(NAV + TEXT + AFTER)}</body>", Weights()) == WANTED


def test_what_is_small_beside_the_article_goes():
    for other in ("<aside>teaser text</aside>", "<div class=sidebar><article>teaser</article></div>", "<form>name</form>",
                  "<div class='social-policy'>share it</div>"):
        assert main_text(f"<div>{TEXT}{other}</div>", Weights()) == WANTED
        assert main_text(f"<main>{TEXT}{other}</main>", Weights()) == WANTED
    assert main_text(f"<div>{TEXT}<header>site</header></div>", Weights()) == WANTED


def test_what_holds_no_article_is_none_however_large():
    for other in ("<div class=comments>{}</div>", "<nav>{}</nav>", "<footer>{}</footer>", "<div class=cookie-notice>{}</div>"):
        assert main_text(f"<body>{other.format(TEXT)}</body>", Weights()) == ""
        assert main_text(f"<body><article><p>short text</p></article>{other.format(TEXT)}</body>", Weights()) == "short text"
