"""Main text of layouts that the model was not trained on, and of broken pages."""

import random
import time

import pytest

from barwise.llm import html_pages, html_text
from barwise.llm.dom import parse

rnd = random.Random(77)
S, M, L = (lambda: html_pages.prose(rnd, 3, 8)), (lambda: html_pages.prose(rnd, 12, 35)), (lambda: html_pages.prose(rnd, 40, 120))


def text_of(page):
    return html_text.main_texts([page], html_text.train())[0].split("\n\n")


def whole(x):
    return " ".join(x.split())


def test_comments_inside_the_article_go():
    for shape in ("<section class='comments'><h3>Comments</h3><p>{}</p></section>", "<div id='comments'><div class='comment'><p>{}</p></div></div>",
                  "<section id='comments'><article class='comment'><p>{}</p></article></section>", "<ol class='comment-list'><li class='comment'><p>{}</p></li></ol>"):
        a, b, c, talk = S(), L(), M(), M()
        got = text_of(f"<html><body><nav><a href='/'>x</a></nav><article><h1>{a}</h1><p>{b}</p><p>{c}</p>{shape.format(talk)}</article><footer>{S()}</footer></body></html>")
        assert got == [whole(a), whole(b), whole(c)], shape


def test_definition_lists_stay():
    a, b, c, d, e = S(), M(), "Term", M(), L()
    got = text_of(f"<body><header><a href='/'>home</a></header><article><h1>{a}</h1><p>{b}</p><dl><dt>{c}</dt><dd>{d}</dd></dl><p>{e}</p></article></body>")
    assert got == [whole(x) for x in (a, b, c, d, e)]


@pytest.mark.parametrize("tag", ["svg", "noscript", "select", "object", "iframe", "template"])
def test_an_unclosed_silent_element_ends_with_its_block(tag):
    a, b, c = S(), L(), L()
    got = text_of(f"<body><article><h1>{a}</h1><p>{b}</p><div class='icon'><{tag}><x>noise</div><p>{c}</p></article></body>")
    assert got == [whole(a), whole(b), whole(c)]
    assert text_of(f"<body><article><p>{b}</p><{tag}><p>noise</p></{tag}><p>{c}</p></article></body>") == [whole(b), whole(c)]


def test_deep_markup_takes_time_in_proportion():
    def seconds(n):
        page = "<b>" * n + "</i></u>" * n + "<p>text" + "</b>" * n
        at = time.process_time()
        assert [x.text for x in parse(page) if x.text] == ["text"]
        return time.process_time() - at
    assert min(seconds(40_000) for _ in range(2)) < 2


LAYOUTS = [
    # text blocks by mark: + is main text, - is not
    "<body><div class='site-nav menu'><a href='/'>{-s}</a></div><main><article><div class='byline meta'><a href='/'>{-s}</a></div><p>{+l}</p><p>{+m}</p></article></main></body>",
    "<body><nav><ul><li><a href='/a'>{-w}</a></li></ul></nav><section class='content'><h2>{+s}</h2><p>{+l}</p><ol><li>{+m}</li></ol></section><aside><p>{-m}</p></aside></body>",
    "<body><article><h1>{+s}</h1><p>{+l}</p><table><tr><th>{+w}</th><td>{+m}</td></tr></table><section class='comments'><p>{-m}</p></section></article><footer><p>{-m}</p></footer></body>",
    "<body><div class='cookie consent'>{-m}</div><div class='post'><h1>{+s}</h1><blockquote><p>{+m}</p></blockquote><p>{+l}</p></div><div class='sidebar'>{-l}</div></body>",
    "<body><main><h1>{+s}</h1><p>{+l}</p><figure><figcaption>{+s}</figcaption></figure><dl><dt>{+w}</dt><dd>{+m}</dd></dl></main><div class='related'><a href='/'>{-s}</a></div></body>",
]


def test_layouts_not_trained_on():
    right = total = 0
    for layout in LAYOUTS * 8:
        want, parts = [], layout.split("{")
        page = parts[0]
        for part in parts[1:]:
            mark, rest = part.split("}", 1)
            text = {"s": S, "m": M, "l": L, "w": lambda: html_pages.word(rnd)}[mark[1]]()
            want += [whole(text)] if mark[0] == "+" else []
            page += text + rest
        got = text_of(page)
        right += len(set(got) & set(want))
        total += len(set(got) | set(want))
    assert right / total > 0.97, (right, total)
