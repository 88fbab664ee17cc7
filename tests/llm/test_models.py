"""Language, quality, licence and HTML models: held-out accuracy and odd rows."""

import re

import pytest

from barwise.llm import html_pages, html_text, langid, licenses, quality
from barwise.llm.dom import parse

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out_documents(docs):
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = [r for r in langid.identify(docs).collect() if r.held_out]
    assert len(out) > 200 and sum(truth[r.doc_id] == r.lang_pred for r in out) / len(out) > 0.98


def test_language_of_odd_rows(frame):
    rows = [(1, "the cat and the dog were here", "en"), (3, "der hund und die katze waren da", "de"), (4, "the dog is with the cat", "en"), (5, None, "en"),
            (6, "123 !!", "en"), (7, "", None), (8, "der die und das", None), (9, "the " * 300_000, "en"), (None, "the dog", "de"), (None, "the dog", "de")]
    out = {(r.doc_id, r.text_key): r for r in langid.identify(frame([(*r, 0) for r in rows], "doc_id long, text string, lang string, score int")).collect()}
    by_id = {k[0]: r for k, r in out.items()}
    assert [by_id[i].lang_pred for i in (5, 6, 7)] == ["und"] * 3 and by_id[8].lang_pred == "de" and by_id[9].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in out.values()) and not by_id[None].held_out
    assert langid.identify(frame([], "doc_id long, text string, lang string")).count() == 0
    assert {r.lang_pred for r in langid.identify(frame([(1, "text", None)], "doc_id long, text string, lang string")).collect()} == {"und"}


def test_rejected_documents_go(frame):
    rows = [(1, "the cat and the dog were here", "en", "a"), (3, "der hund und die katze waren da", "de", "b"), (4, "12 34", "en", "c"), (5, None, "en", "d")]
    out = langid.accepted(frame(rows, "doc_id long, text string, lang string, lang_pred string"))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred"] and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_quality_of_held_out_documents(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    out = quality.classify(docs, labels).collect()
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(out) == docs.count() and sum(truth[r.doc_id] == r.predicted for r in held) / len(held) > 0.93


def test_quality_of_odd_rows(frame):
    rows = [(1, "plain words here"), (2, None), (3, ""), (5, "### *** " * 40_000), (None, "plain"), (6, "plain words here")]
    labels = frame([(1, 1, 0), (5, 0, 0), (5, 0, 1), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.classify(frame(rows), labels).collect()}
    assert len(out) == 6 - 0 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert out[2].score == out[3].score and out[1].score == out[6].score
    none = quality.classify(frame(rows), frame([], "doc_id long, quality int, toxic int")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(frame([]), labels).count() == 0


def test_score_does_not_depend_on_the_batch():
    net = quality.train([b"good words in here", b"*** ###"] * 4, __import__("numpy").array([1.0, 0.0] * 4))
    texts = [b"good words", b"", b"x" * 70_000, b"### ***", b"good words in here " * 30]
    together = net.score(texts)
    assert [float(net.score([t])[0]) for t in texts] == pytest.approx(list(together))


def test_licences_equal_the_planted_lines(docs):
    planted = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "This work is licensed under the GNU General Public License, version 3.": "gpl",
               "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "All rights reserved.": "all-rights-reserved"}
    out = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        lines = [i for i, x in enumerate(r.text.split("\n")) if x in planted]
        assert out[r.doc_id].lines == lines and out[r.doc_id].families == ",".join(sorted({planted[r.text.split("\n")[i]] for i in lines}))


def test_licences_of_odd_rows(frame):
    rows = [(1, None), (2, ""), (3, "prose\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files (the \"Software\"), to deal in the Software without restriction."), (4, "She renewed her fishing license.\nThe license fee is due."),
            (None, "All rights reserved."), (5, "word " * 100_000), (3, "other text"), (6, "x\nSPDX-License-Identifier: MIT\nRELEASED UNDER THE MIT LICENSE")]
    out = licenses.scan(frame([(*r, "x") for r in rows], "doc_id long, text string, words string")).collect()
    got = sorted((str(r.doc_id), r.families, r.lines) for r in out)
    assert got == sorted([("1", "", []), ("2", "", []), ("3", "mit", [2]), ("3", "", []), ("4", "", []), ("None", "all-rights-reserved", [0]), ("5", "", []), ("6", "mit", [1, 2])])
    assert licenses.scan(frame([])).count() == 0


def test_main_text_of_held_out_layouts():
    for nodes, labels in html_pages.pages(120, 777):
        p = html_text.Forest([nodes]).marginals(*html_text.train())[0][:, 1]
        assert [n.text for n, y in zip(nodes, labels) if n.text and y] == [n.text for n, x in zip(nodes, p) if n.text and x > 0.5]


def test_main_text_of_pages(spark):
    import html
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        runs = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert out[r.page_id].text == "\n\n".join(x for x in runs if x) and out[r.page_id].n_chars == len(out[r.page_id].text)


def test_main_text_of_odd_rows(frame):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>A &lt;b&gt; &eacute;<p>x</article>"), (4, "u", "<div>" * 3000 + "deep"), (5, "u", "<script>var x = '<p>no</p>'"),
            (6, "u", "<nav><a href='/'>menu</a></nav><article><p>" + "long words " * 50_000 + "</p></article><footer>foot</footer>"), (7, "u", "<article><p>cut off in a ta")]
    out = {r.page_id: r for r in html_text.extract(frame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")).collect()}
    assert [out[i].text for i in (1, 2, 5)] == [""] * 3 and out[None].text == "A <b> é\n\nx" and out[7].text == "cut off in a ta"
    assert out[6].text == ("long words " * 50_000).strip() and out[6].n_chars == len(out[6].text)
    assert html_text.extract(frame([], "page_id long, url string, html string")).count() == 0


def test_marginals_equal_enumeration():
    import itertools
    import numpy as np
    nodes = parse("<div><p>one</p><ul><li>two</li></ul></div>")
    rnd = np.random.default_rng(1)
    own, edge = rnd.normal(size=(1 << html_text.BITS, 2)), rnd.normal(size=(1 << html_text.BITS, 2, 2))
    features = html_text.node_features(nodes)
    total = np.zeros((len(nodes), 2))
    for y in itertools.product((0, 1), repeat=len(nodes)):
        s = sum(own[f, y[i]] for i, fs in enumerate(features) for f in fs)
        s += sum(edge[f, y[n.parent], y[i]] for i, (n, fs) in enumerate(zip(nodes, features)) if n.parent >= 0 for f in fs)
        for i in range(len(nodes)):
            total[i, y[i]] += np.exp(s)
    assert np.allclose(total / total.sum(axis=1, keepdims=True), html_text.Forest([nodes]).marginals(own, edge)[0])
