"""Texts in no learned language go from the language stage; clean documents stay."""

import random

from pyspark.sql import functions as F

from barwise.llm import langid

SF = "/root/testdata/sf0.01"


def noise():
    rnd, out = random.Random(3), []
    alphabets = {"han": [chr(x) for x in range(0x4E00, 0x5E00)], "greek": [chr(x) for x in range(0x3B1, 0x3CA)] + [" "] * 4,
                 "cyrillic": [chr(x) for x in range(0x430, 0x450)] + [" "] * 5, "mash": list("abcdefghijklmnopqrstuvwxyz") + [" "] * 4,
                 "home row": list("asdfghjkl") + [" "]}
    for name, letters in alphabets.items():
        out += [(name, "".join(rnd.choice(letters) for _ in range(n))) for n in (200, 2000) for _ in range(20)]
    return out


def test_unlearned_scripts_and_noise_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(10_000_000 + i, text, None) for i, (_, text) in enumerate(noise())]
    both = docs.union(spark.createDataFrame(odd, docs.schema))
    kept = {r.doc_id for r in langid.accepted(both).collect()}
    assert not [x for x in kept if x >= 10_000_000]
    assert kept == {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()}
