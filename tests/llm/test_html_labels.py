from panelkit.llm.html_text import Weights, main_text


def test_a_label_does_not_decide_alone():
    text = "one of the many words in this long text " * 20
    page = f"<main><p>{text}</p></main><section><ul><li><a>x</a></li></ul><article>teaser</article></section>"
    assert main_text(page, Weights()) == text.strip()
    page = f"<article>short teaser</article><nav>menu</nav><div class=content><p>{text}</p></div>"
    assert text.strip() in main_text(page, Weights(by_feature={"p": 1.0}))
