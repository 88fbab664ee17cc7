"""Labelled training pages for the content extractor, built from layouts.

A layout is markup whose block elements carry ``y="1"`` (main text) or
``y="0"``; text inherits the label of the nearest such element.  Readers'
comments stand after the body or inside its end.  ``{s}``,
``{m}`` and ``{l}`` stand for short, middle and long invented prose, ``{w}``
for a word.  Pages come from all combinations of a frame and a body, with
seeded prose, so the model sees long adverts and very short paragraphs alike.
"""

from __future__ import annotations

import random

from barwise.llm.dom import Node, parse

MENUS = [
    '<nav y="0"><ul><li><a href="/{w}">{w}</a></li><li><a href="/{w}">{w} {w}</a></li><li><a href="/{w}">{w}</a></li></ul></nav>',
    '<header y="0"><div class="logo">{w}</div><p>{s}</p><nav><a href="/">{w}</a> <a href="/x">{w}</a></nav></header>',
    '<div id="menu" y="0"><ul class="menu"><li><a href="/a">{w}</a><li><a href="/b">{w}</a></ul></div>',
    '<div class="topbar navbar" y="0"><a href="#">{w}</a> | <a href="#">{w}</a></div><div class="breadcrumb breadcrumbs" y="0"><a href="/">{w}</a> / {w}</div>',
    "",
]
EXTRAS = [
    '<div class="ad" y="0">{m}</div>', '<div class="ads advert banner" y="0"><p>{l}</p></div>', '<aside y="0"><h3>{w}</h3><p>{m}</p><ul><li><a href="#">{s}</a></li></ul></aside>',
    '<div class="cookie notice consent" y="0"><p>{m}</p><button>{w}</button></div>', '<form y="0"><p>{s}</p><label>{w}</label><input><div>{w}</div></form>',
    '<div class="sidebar" y="0"><h2>{w}</h2><p>{l}</p><a href="#">{s}</a></div>', '<div class="alert notice" y="0">{m}</div>',
    '<div class="sponsored promo" y="0"><a href="#">{s}</a><p>{m}</p></div>', '<div class="newsletter signup subscribe" y="0"><h3>{s}</h3><p>{m}</p></div>',
    '<section class="related" y="0"><h2>{w} {w}</h2><ul><li><a href="#">{s}</a></li><li><a href="#">{s}</a></li></ul></section>', "", "",
]
TALK = [
    '<section id="comments" class="comments" y="0"><h2>{w}</h2><div class="comment"><p class="author">{w}</p><p>{m}</p></div><div class="comment"><p>{l}</p></div></section>',
    '<div class="comment-list comments" y="0"><ol><li class="comment"><p>{m}</p></li><li class="comment"><p>{l}</p></li></ol><form><p>{s}</p></form></div>',
    '<section class="reactions responses comments" y="0"><article class="comment"><p>{l}</p></article><article class="comment reply"><p>{m}</p></article></section>',
    '<section class="comments" y="0"><p>{m}</p><p>{s}</p></section>', '<div id="comments" y="0"><h3>{w}</h3><p>{l}</p><p>{m}</p></div>', "", "",
]
FEET = [
    '<footer y="0">{m}</footer>', '<footer y="0"><p>{s}</p><ul><li><a href="#">{w}</a></li></ul><div>{m}</div></footer>', '<div id="footer" class="footer" y="0"><p>{m}</p></div>',
    '<div class="copyright legal" y="0">{s}</div>', "",
]
BODIES = [
    '<article y="1"><h1>{s}</h1><p>{l}</p><p>{w}.</p><p>{m}</p><p>{l}</p></article>', '<article y="1"><h1>{w}</h1><p>{w}.</p></article>',
    '<article y="1"><h1>{s}</h1><p><b>{m}<br><p>{s}</p><p><b>{w}.<br><p>{l}</p></article>', '<article y="1"><h1>{s}</h1>{l}<p>{m}</article>',
    '<main y="1"><h1>{s}</h1><p>{l}</p><ul><li>{s}</li><li>{m}</li><li>{w}</li></ul><p>{s}</p><blockquote>{m}</blockquote></main>',
    '<main><article y="1"><h1>{s}</h1><div class="share social" y="0"><a href="#">{w}</a> <a href="#">{w}</a></div><p>{m}</p><h2>{s}</h2><p>{l}</p>'
    '<div class="ad" y="0">{m}</div><p>{s}</p><aside y="0"><p>{m}</p></aside><table><tr><td>{w}</td><td>{s}</td></tr></table><p>{l}</p></article></main>',
    '<div class="content" y="1"><h1>{s}</h1><p>{l}</p><p>{s}</p><h2>{w}</h2><p>{m}</p><pre>{s}</pre></div>',
    '<div id="main"><div class="post entry" y="1"><h2>{s}</h2><p>{m}</p><p>{l}</p><div class="tags meta" y="0"><a href="#">{w}</a><a href="#">{w}</a></div></div></div>',
    '<div><div y="1"><p>{l}</p><p>{l}</p><p>{s}</p></div></div>', '<article y="1"><section><h2>{s}</h2><p>{w} {w}</p><p>{l}</p></section><section><h2>{w}</h2><p>{s}</p></section>'
    '<figure><figcaption>{s}</figcaption></figure></article>',
    '<article class="story" y="1"><h1>{s}</h1><p>{m} <a href="#">{w}</a> {s}</p><p>{m}</p><form y="0"><p>{s}</p></form><p>{w}</p></article>',
    '<main y="1"><p>{l}</p><p>{w}</p></main>', "",
    '<article y="1"><h1>{s}</h1><p>{m}</p><dl><dt>{w}</dt><dd>{m}</dd><dt>{w} {w}</dt><dd>{s}</dd></dl><p>{l}</p></article>',
    '<div class="content body" y="1"><h1>{s}</h1><dl class="facts"><dt>{w}<dd>{s}<dt>{s}<dd>{l}</dl><ol><li>{m}</li><li>{s}</li></ol></div>',
]
#: Ends of a body before which readers' comments may stand, and their share of the pages.
CLOSERS, INSIDE = ("</article>", "</main>", "</div>"), 0.35
VOWELS, OTHERS = "aeiou", "bcdfglmnprstv"


def word(rnd: random.Random) -> str:
    return "".join(rnd.choice(OTHERS) + rnd.choice(VOWELS) for _ in range(rnd.randint(1, 4)))


def prose(rnd: random.Random, least: int, most: int) -> str:
    style = rnd.random()
    words = [word(rnd) for _ in range(rnd.randint(least, most))]
    if style < 0.1:
        words = [w.upper() + "!!" for w in words]
    elif style < 0.2:
        words = [w + rnd.choice(["***", "###", " |"]) for w in words]
    return " ".join(words).capitalize() + rnd.choice([".", ".", ""])


def page(rnd: random.Random) -> tuple[list[Node], list[int]]:
    """Nodes of a random page and their labels (1: main text)."""
    parts = [rnd.choice(MENUS), rnd.choice(EXTRAS), rnd.choice(EXTRAS) if rnd.random() < 0.5 else "", rnd.choice(BODIES), rnd.choice(TALK),
             rnd.choice(EXTRAS) if rnd.random() < 0.5 else "", rnd.choice(FEET)]
    talk = rnd.choice(TALK)
    closer = next((c for c in CLOSERS if parts[3].rstrip().endswith(c)), None)
    if talk and closer and rnd.random() < INSIDE:
        parts[3] = parts[3].rstrip()[: -len(closer)] + talk + closer
    layout = '<html y="0"><head><title>x</title></head><body y="0">' + "".join(parts)
    for mark, least, most in (("{w}", 1, 1), ("{s}", 2, 9), ("{m}", 8, 40), ("{l}", 30, 160)):
        while mark in layout:
            layout = layout.replace(mark, prose(rnd, least, most), 1)
    # the label rides on the class attribute, so that the parser is the one in use
    layout = layout.replace(' y="0"', ' role="ynot"').replace(' y="1"', ' role="yes"')
    nodes, labels = parse(layout), []
    for n in nodes:
        own = 1 if "yes" in n.names else 0 if "ynot" in n.names else None
        labels.append(own if own is not None else labels[n.parent] if n.parent >= 0 else 0)
        n.names = tuple(x for x in n.names if x not in ("yes", "ynot"))
    return nodes, labels


def pages(count: int, seed: int) -> list[tuple[list[Node], list[int]]]:
    rnd = random.Random(seed)
    return [page(rnd) for _ in range(count)]
