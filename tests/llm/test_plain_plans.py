"""Words are cut by one split, and fixed tables of the licence scan need no Python worker."""

import re

from pyspark.sql import functions as F

from barwise.llm import decontaminate, licenses


def plan(df):
    return df._jdf.queryExecution().toString()


def test_words_equal_the_contract_class(spark, frame):
    odd = ["", None, " ", "a", "a b", " a  b ", "Straße café naïve", "中文 x中y", "0zZ9_9A", "\x00a\x7fb\x80c͸d", "a b c", "x퟿y", "🙂a🙂 🙂",
           "".join(map(chr, range(1, 0x200))), *(f"a{chr(i)}b" for i in range(0x100))]
    rows = frame([(i, t) for i, t in enumerate(odd)])
    said = rows.select("doc_id", F.transform(decontaminate.words(), lambda w: F.translate(w, decontaminate.UPPER, decontaminate.LOWER)).alias("w"))
    got = {r.doc_id: r.w for r in said.collect()}
    for i, text in enumerate(odd):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        assert got[i] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low), repr(text)
    assert "regexp_extract_all" not in plan(said) and "split(" in plan(said)


def test_fixed_tables_lie_in_the_plan(spark):
    known = licenses.templates(spark)
    assert "LocalTableScan" in plan(known) and "ExistingRDD" not in plan(known)
    assert {r.family for r in known.collect()} == set(licenses.TEMPLATES)
    assert dict(known.dtypes)["number"] == "int"
