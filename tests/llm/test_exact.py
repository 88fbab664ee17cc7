"""Decontamination, URL filters, packing and fingerprints against plain Python."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barwise.llm import decontaminate, fingerprints, packing, url_filter
from barwise.llm.queries import op3_url_filter
from barwise.llm.url_filter import Rule

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The five host rules of the query, written out here as well.
HOST_RULES = [Rule("com/", "allow"), Rule("example.com/en/", "block"), Rule("www.example.com/en/", "allow"),
              Rule("net/es/", "block"), Rule("net/fr/", "block")]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def said(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_contamination(rows, items, size=13):
    windows = {}
    for item, text in items:
        w = said(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        w, hit, found = said(text), set(), set()
        for window, names in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i:i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= names
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(frame):
    long_item = "alpha beta gamma " + " ".join(f"w{i}" for i in range(20))
    items = [(1, long_item), (2, "Short Été item"), (10, "the"), (3, None), (4, "  ,; "), (1, long_item), (5, "never said anywhere at all")]
    filler = " ".join(f"f{i}" for i in range(400))
    rows = [(1, long_item.upper()), (2, f"{filler} {long_item} {filler}"), (3, None), (4, ""), (5, "x short ÉTÉ item y"), (6, "x SHORT Été,item y"),
            (7, f"THE {filler}"), (8, " ".join(long_item.split()[4:17]) * 1), (9, " ".join(long_item.split()[4:16])), (None, "the the the"),
            (9, " ".join(long_item.split()[4:16])), (9, "the other text"), (11, "the " * 30_000), (12, "w" * 100_000)]
    got = decontaminate.contamination(frame(rows), frame(items, "item_id long, text string")).drop("text_key").collect()
    assert sorted(map(tuple, got), key=str) == brute_contamination(rows, items)


def test_items_without_an_id_hit_but_are_not_listed(frame):
    items = frame([(None, "one two three"), (5, "three four"), (None, "five six")], "item_id long, text string")
    rows = [(1, "one two three"), (2, "one two three four"), (3, "five six three four"), (4, "clean words")]
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(frame(rows), items).collect()}
    assert got == {1: (3, 0, True), 2: (4, 1, True), 3: (4, 1, True), 4: (0, 0, False)}
    assert sorted(r.doc_id for r in decontaminate.clean(frame(rows), items).collect()) == [4]


def test_contamination_of_empty_tables_and_clean_columns(frame):
    items = frame([(1, "one two three")], "item_id long, text string")
    assert decontaminate.contamination(frame([]), items).count() == 0
    assert not decontaminate.contamination(frame([(1, "one two three")]), frame([], "item_id long, text string")).first().contaminated
    rows = [(1, "one two three", "a"), (2, "fine words", "b"), (None, None, "c")]
    out = decontaminate.clean(frame(rows, "doc_id long, text string, word string"), items)
    assert out.columns == ["doc_id", "text", "word"] and sorted(r.word for r in out.collect()) == ["b", "c"]


def brute_verdict(url, rules):
    i = (url or "").find("://")
    rest = url[i + 3:] if url and i >= 0 else ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    host, path = m[1].lower(), m[2]
    best, verdict = None, "allow"
    for r in rules:
        if r.kind == "host":
            h, _, p = r.rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(r.rule) > len(best.rule if best else ""):
                best = r
    low = (host + path).lower()
    if best:
        return host, path, best.rule, best.verdict
    for r in rules:
        if r.kind == "pattern" and any(c.isalnum() for c in low) and re.search(r.expression(), low):
            verdict = "block"
    return host, path, None, verdict


def test_verdicts_equal_brute_force(spark, frame):
    rules = HOST_RULES + url_filter.PATTERNS + [Rule("net/en/a", "block"), Rule("*zz*", "block", "pattern")]
    urls = ["http://EXAMPLE.com/en/1", "https://www.example.com/en/", "http://com/x", "http://example.com", "http://a.example.com/en", "http://notcom/",
            "http://x.net/es/1", "http://x.net/fr?q=/fr/", "http://x.net/fr/#a", "ftp://casino-win.example.org/", "http://a.org/b/casino-x.html", "http://mycasino-x.org/",
            "http://free-bets.org", "http://x.org/free-betsy", "http://x.org/fizzbuzz", "//net/es/", "", None, "http://", "x://y://com/", "http://x.net/EN/a", "http://x.net/en/abc",
            "http://x.org/PORN", "http://a.b/cgi-bin/run", "http://com/x", "http://é.net/fr/ü"]
    urls += [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    rows = [(None if i == 3 else i, u) for i, u in enumerate(urls)]
    got = url_filter.judge(frame([(*r, "x") for r in rows], "page_id long, url string, token string"), rules).drop("url").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute_verdict(u, rules)) for i, u in rows), key=str)
    assert url_filter.judge(frame([], "page_id long, url string"), rules).count() == 0


def test_the_query_applies_the_five_rules(spark, frame, tmp_path):
    want = {"http://a.net/es/x": ("net/es/", "block"), "http://net/fr/": ("net/fr/", "block"), "http://b.com/x": ("com/", "allow"),
            "http://example.com/en/1": ("example.com/en/", "block"), "http://www.example.com/en/1": ("www.example.com/en/", "allow"),
            "http://example.com/es/1": ("com/", "allow"), "http://a.net/en/x": (None, "allow")}
    frame([(i, u, "") for i, u in enumerate(want)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in op3_url_filter(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())


def test_rules_are_indexed_by_their_rarest_token(frame):
    tokens = frame([("com",)] * 9 + [("example",)] * 2 + [("en",)] * 4, "token string")
    got = {r.rule: r.token for r in url_filter.indexed(HOST_RULES + [Rule("*zz*", "block", "pattern")], tokens).collect()}
    assert got["example.com/en/"] == "example" and got["com/"] == "com" and got["*zz*"] is None and got["www.example.com/en/"] == "www"


TEXTS = ["", "Hello world.", "two  spaces and   three", "line\nbreak \n mixed\n\n x", " lead", "trail ", "\ttab a\xa0 b", "it's <|endoftext|> fine", "end  <|endoftext|>  x", "<|endoftext|>", "<|endoftext|", "a<|endoftext|>b\n", "a\u3000 b", "é" * 3000,
         "word " * 5000, "日本語 テキスト です", "1234 56.78 $%^ &*", "\n", " ", "x\x1f y", "tab\t end", "a.\nB", "The***\nend.\nx y", "it's.\n\nNo", "x²y z1 _a. b_", "ab\n", None]


@pytest.mark.parametrize("ranks", [None, public_tokenizers.path("byte_bpe_50k.tiktoken")])
def test_pieces_rebuild_the_tokenizers_ids(spark, frame, ranks):
    rows = list(enumerate(TEXTS)) + [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        (__import__("pyspark").sql.functions.col("doc_id") + 100).alias("doc_id"), "text").collect()] + [(None, "null id")]
    t = Tokenizer.from_file(TOKENIZER)
    out = packing.pack_documents(frame(rows), TOKENIZER, ranks=ranks).collect()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            part = ids[r.start: r.start + r.length]
            assert (r.piece, r.start, r.length) == (k, at, len(part)) and (k == 0 or r.length == 1024)
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += r.length
        assert at == len(ids)
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out], 1024)


def check_sequences(rows, capacity):
    bins = {}
    for s, offset, length in rows:
        bins.setdefault(s, []).append((offset, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("sizes", [[], [5], [10] * 7, [6, 5, 5, 4] * 40, None])
def test_packing_reaches_the_bound(spark, frame, monkeypatch, sizes):
    monkeypatch.setattr(packing, "PIECES", 300)
    rnd = random.Random(3)
    capacity = 10 if sizes is not None else 1024
    sizes = [rnd.randint(1, 1023) for _ in range(900)] if sizes is None else sizes
    df = frame(list(enumerate(sizes)), "pid long, length long")
    got = packing.pack(df, capacity).join(df, "pid").collect()
    assert sorted(r.pid for r in got) == list(range(len(sizes)))
    import numpy as np
    n = check_sequences([(r.sequence_id, r.offset, r.length) for r in got], capacity)
    assert n <= 1.02 * (packing.best_fit(np.array(sizes), capacity)[2] if sizes else 0)


def test_lower_bound_never_exceeds_the_best_packing():
    import itertools
    import numpy as np
    rnd = random.Random(8)

    def fits(sizes, n, capacity):
        return any(all(sum(s for s, b in zip(sizes, where) if b == k) <= capacity for k in range(n)) for where in itertools.product(range(n), repeat=len(sizes)))
    for _ in range(60):
        sizes = [rnd.randint(1, 12) for _ in range(rnd.randint(1, 6))]
        best = next(n for n in range(1, 7) if fits(sizes, n, 12))
        assert packing.lower_bound(np.array(sizes), 12) <= best <= packing.best_fit(np.array(sizes), 12)[2]


def test_fingerprints_of_documents_and_edits(spark, frame):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = docs + [(5000, None), (5001, ""), (5002, "é" * 70_000 + " end"), (5003, docs[0][1]), (None, "no id here")]
    out = {r.doc_id: r for r in fingerprints.fingerprints(frame(rows, parts=5)).collect()}
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(out) == len(rows)

    def bits(x):
        return [x[i:i + 4] for i in range(0, len(x), 4)]

    def jaccard(a, b):
        def s(t):
            w = t.encode().lower().split()
            return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        a, b = s(a), s(b)
        return len(a & b) / len(a | b) if a | b else 1.0
    error = []
    for (doc_id, text), (after, other) in zip(ordered, ordered[1:] + ordered[:1]):
        r, n = out[doc_id], len(text)
        edited = text[: n - n // 2] + other[: n // 2]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == sum(x == y for x, y in zip(bits(r.fingerprint), bits(out[after].fingerprint))) / fingerprints.HASHES
        assert r.edited_fingerprint == fingerprints.signatures([edited.encode()])[0].tobytes().hex()
        error.append(abs(r.near_edited - jaccard(text, edited)))
    assert out[5003].fingerprint == out[docs[0][0]].fingerprint and out[5000].fingerprint == out[5001].fingerprint == "ffff" * 128
    assert sum(error) / len(error) < 0.04 and max(error) < 0.25
    assert fingerprints.fingerprints(frame([])).count() == 0


def test_fingerprint_of_one_row_and_repeated_rows(frame):
    one = fingerprints.fingerprints(frame([(1, "abcd")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert fingerprints.fingerprints(frame([(1, "abcd"), (1, "abcd"), (1, "zz")])).count() == 3


def test_near_copies_equal_brute_force(spark, frame):
    rnd = random.Random(4)
    base = [rnd.choice("abcdefghij") * 3 + str(rnd.randrange(200)) for _ in range(120)]
    rows = []
    for i in range(25):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 2, 9])):
            w[rnd.randrange(120)] = f"new{rnd.randrange(999)}"
        rows.append((i, " ".join(w)))
    rows += [(100, None), (101, ""), (102, "alone in the world it is")]

    def s(t):
        w = (t or "").split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    found = {(min(r.doc_id, r.other_id), max(r.doc_id, r.other_id)): r.jaccard for r in fingerprints.near_copies(frame(rows)).collect()}
    first = {}
    for d, t in rows:
        first.setdefault(t, d)
    true = {(a, b) for a, t in rows for b, u in rows if a < b and first[t] == a and first[u] == b and s(t) and s(u) and len(s(t) & s(u)) >= 0.8 * len(s(t) | s(u))}
    assert set(found) <= true
    linked = {x for pair in found for x in pair}
    assert linked == {x for pair in true for x in pair}
