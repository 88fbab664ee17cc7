"""The pipeline's stages, each against brute force on its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_exact import brute_contamination, check_sequences
from test_similarity import brute_groups, brute_lines

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_follow_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "x", 0), (9002, "12 34 !!", "en", "x", 8), (9003, "", "en", "x", 0)], docs.schema)
    docs = docs.unionByName(odd)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "near_copies", "benchmarks", "sequences"]

    given, kept = rows(docs), stages["language"](spark, docs, SF).cache()
    assert kept.columns == docs.columns
    assert sorted(given) != sorted(rows(kept)) and {d for d, _ in given} - {d for d, _ in rows(kept)} == {9001, 9002, 9003}

    given, lines = rows(kept), stages["lines"](spark, kept, SF).cache()
    gone = dict(brute_lines(given, 5, 80))
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in given}
    want = {d: t for d, t in want.items() if t.strip() or not gone[d]}
    assert lines.columns == docs.columns and dict(rows(lines)) == want and len(rows(lines)) < len(given)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    given, one = rows(lines), stages["near_copies"](spark, lines, SF).cache()
    want = sorted(d for d, _, c in brute_groups(given, 5, 80) if d == c)
    assert one.columns == docs.columns and sorted(d for d, _ in rows(one)) == want

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given, clean = rows(one), stages["benchmarks"](spark, one, SF).cache()
    want = sorted(x[0] for x in brute_contamination(given, items) if not x[-1])
    assert clean.columns == docs.columns and sorted(d for d, _ in rows(clean)) == want and len(want) < len(given)

    out = stages["sequences"](spark, clean, SF).collect()
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out], 1024)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    size = {d: len(t.encode(x, add_special_tokens=False).ids) + 1 for d, x in rows(clean)}
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == size


def test_run_writes_every_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
