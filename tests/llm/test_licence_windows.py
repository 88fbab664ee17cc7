"""Licence notices inside long paragraphs."""

import re

from barwise.llm import licenses

SF = "/root/testdata/sf0.01"


def test_notices_inside_long_paragraphs(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    prose = [w for r in docs.orderBy("doc_id").limit(150).collect() for x in r.text.split("\n") if not re.search(licenses.CUES, x) for w in x.split()]
    rows, want = [], {}
    for i, (family, text) in enumerate([(f, t) for f, texts in licenses.TEMPLATES.items() for t in texts]):
        for j, n in enumerate((20, 40, 80, 300, 1500)):
            doc_id, at = 1_000_000 + 10 * i + j, (977 * i + 131 * j) % (len(prose) - n)
            words = prose[at: at + n]
            cut = n // 2 + i % 16
            rows.append((doc_id, "\n".join(["first line", " ".join(words[:cut] + text.split() + words[cut:])])))
            want[doc_id] = family
    mit, gpl = licenses.TEMPLATES["mit"][0], licenses.TEMPLATES["gpl"][0]
    rows.append((2_000_000, " ".join([*prose[:100], mit, *prose[100:200], gpl, *prose[200:300]])))
    rows += [(3_000_000 + i, " ".join(prose[400 * i: 400 * i + 400])) for i in range(20)]
    out = {r.doc_id: (r.families, r.lines) for r in licenses.scan(docs.union(frame(rows))).collect()}
    wrong = {d: (f, out[d]) for d, f in want.items() if out[d] != (f, [1])}
    assert not wrong, wrong
    assert out[2_000_000] == ("gpl,mit", [0])
    assert [out[3_000_000 + i] for i in range(20)] == [("", [])] * 20
