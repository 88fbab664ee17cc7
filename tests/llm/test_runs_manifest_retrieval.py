"""Periodic runs, the Merkle manifest and retrieval packing against plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barwise.llm import merkle, periodic_runs, queries, retrieval_packing

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs

def brute_runs(w):
    """Every period's maximal stretches, whose smallest period it is."""
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(24, 3 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text, plant):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    best = (*top[0], int(Fraction(1000 * top[0][1], top[0][2]))) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def periodic_texts(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        w = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(60))]
        for _ in range(rnd.randrange(4)):
            q = rnd.choice([1, 2, 3, 5, 7, 8, 9, 11, 12, 13, 16, 19, 24, 31, 40])
            block = [rnd.choice("ab" if rnd.random() < 0.4 else "abcdefghijklm") for _ in range(q)]
            length = int(q * rnd.choice([2, 2.9, 3, 3, 3.4, 6])) + rnd.choice([0, 0, 23])
            w += [block[j % q] for j in range(length)] + [rnd.choice("abxyz") for _ in range(rnd.randrange(9))]
        rows.append((i, " ".join(w)))
    return rows


ODD = [(500, None), (501, ""), (502, " \n\t "), (503, "a " * 23), (504, "a\n" * 24), (505, "a b " * 12), (506, "x " + "A a " * 40 + "y"), (507, "a b c " * 8 + "a b d " * 8),
       (None, "a b " * 30), (507, "a b c " * 8 + "a b d " * 8), (508, "a" * 300_000 + " z" * 30), (509, "a b a b c " * 15 + "a b " * 20),
       (510, " ".join(str(i % 700) for i in range(2100))), (511, " ".join(str(i % 701) for i in range(2102))), (512, "a\x1fb\xa0c " * 30)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_equal_brute_force(spark, frame, seed):
    rows = periodic_texts(seed) + (ODD if seed == 1 else [])
    if seed == 2:
        rows += [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").select("doc_id", "text").collect()]
    for change in (periodic_runs.planted, None):
        got = periodic_runs.report(frame([(*r, 1) for r in rows], "doc_id long, text string, period int"), change).collect()
        want = [brute_report(d, t, change) for d, t in rows]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_collapsed_texts_and_empty_table(frame):
    out = {r.doc_id: r for r in periodic_runs.collapse(frame([(1, "x " + "a b " * 13 + "y"), (2, "p  q\nr"), (3, None)])).collect()}
    assert out[1].collapsed == "x a b y" and [tuple(r) for r in out[1].runs] == [(1, 26, 2)]
    assert out[2].collapsed == "p q r" and out[3].collapsed == "" and out[3].runs == []
    assert periodic_runs.report(frame([])).count() == periodic_runs.collapse(frame([])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_small_alphabets(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        docs = []
        for _ in range(rnd.randint(1, 4)):
            block = [rnd.randrange(2) for _ in range(rnd.randint(1, 45))]
            docs.append([rnd.randrange(2) for _ in range(rnd.randrange(30))] + block * rnd.randint(1, 5) + block[:rnd.randrange(len(block))])
        ids, starts = [], []
        for i, d in enumerate(docs):
            starts.append(len(ids))
            ids += d + [10 + i]
        found = periodic_runs.runs(np.array(ids, np.int64), np.array(starts))
        assert found == [(s + n, a, q) for s, d in zip(starts, docs) for n, a, q in brute_runs(d)]


# ---- Merkle manifest

def H(*parts):
    return sha("".join(parts))


def enc(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def brute_tree(leaves, arity=2):
    """Root, and each leaf's siblings by level as (left, right)."""
    level, where, proofs = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, at in enumerate(where):
            base = at - at % arity
            proofs[i].append((level[base:at], level[at + 1:base + arity]))
        level = [H(*level[i:i + arity]) for i in range(0, len(level), arity)]
        where = [at // arity for at in where]
    return level[0], proofs


def brute_manifest(rows, arity=2):
    groups = {}
    for r in rows:
        doc_id, text, lang, source, n_chars = r
        leaf = lambda n: H(*map(enc, (doc_id, source, lang, n, text)))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf(n_chars), doc_id, leaf(n_chars + 1) if hit else leaf(n_chars)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: brute_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], arity) for g in langs}
    root, upper = brute_tree([trees[g][0] for g in langs], arity)
    out = []
    for g, up in zip(langs, upper):
        for (_, _, leaf, doc_id, changed), proof in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            fold = changed
            for left, right in proof + up:
                fold = H(*left, fold, *right)
            out.append((doc_id, leaf, trees[g][0], root, H(*[x for left, right in proof + up for x in left + right]), fold, fold == root))
    return sorted(out, key=str)


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def manifest_rows(n, langs, seed=1):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["", "é text", None, "x" * i]), rnd.choice(langs), rnd.choice(["web", None]), rnd.choice([None, i, 0])) for i in range(n)]


@pytest.mark.parametrize("rows", [manifest_rows(61, ["en", "de", None, "", "é"]), manifest_rows(1, ["en"]), manifest_rows(9, ["en"]),
                                  manifest_rows(12, [None]) + [(3, "again", None, "s", 1)] * 2 + [(None, "no id", None, None, 7), (None, None, "zz", None, None)]])
def test_manifest_equals_brute_force(spark, frame, tmp_path, rows):
    frame([(*r, 0) for r in rows], DOC + ", place int").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, queries.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=str) == brute_manifest(rows)


def test_manifest_of_wider_runs_and_of_given_documents(spark, frame):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    for arity in (3, 5):
        got = merkle.manifest(frame(rows, DOC), arity, tampered).collect()
        proofs = [sha("".join(bytes(x.others).hex() for x in r.path)) for r in got]
        flat = [(r.doc_id, *(bytes(x).hex() for x in (r.leaf, r.subroot, r.root)), p, bytes(r.folded_root).hex(), r.folded_root == r.root) for r, p in zip(got, proofs)]
        assert sorted(flat, key=str) == brute_manifest(rows, arity)
    assert merkle.manifest(frame([], DOC)).count() == 0


# ---- retrieval packing

TEXTS = ["", "Hello world.", "two  spaces and   three", "line\nbreak \n mixed\n\n x", "\ttab a\xa0 b", "it's <|endoftext|> fine", "a<|startoftext|>b <|x", "a　 b", "é" * 3000,
         "word " * 9000, "日本語 テキスト です", "1234 56.78 $%^ &*", "\n", " ", "x\x1f y", "a\x0bb\x85c", "ΑΣ ΣΑΣ", "İstanbul ẞ Ⱥ", "́a é ́", "don't DON'T 's 'll ''s 'tis x.'re",
         "² ª º ÷× ŉ ǅ", None, "the" * 40_000]


def rebuilt(rows, out, length):
    t = Tokenizer.from_file(TOKENIZER)
    pieces, windows = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = {d: t.encode(x or "", add_special_tokens=False).ids + [2] for d, x in rows}
    assert set(pieces) == set(want)
    for d, ids in want.items():
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r.start: r.start + r.length]))
            at += r.length
        assert at == len(ids)
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length and at & (at - 1) == 0               # full, or a power of two: nothing is padded
    return windows


@pytest.mark.parametrize("length,shard", [(4096, 1 << 21), (64, 3000), (256, 1)])
def test_pieces_rebuild_the_tokenizers_ids(spark, frame, monkeypatch, length, shard):
    monkeypatch.setattr(retrieval_packing, "SHARD", shard)
    rows = list(enumerate(TEXTS)) + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(None, "null id")]
    out = retrieval_packing.pack_documents(frame([(*r, 0) for r in rows], "doc_id long, text string, key int"), TOKENIZER, length).collect()
    windows = rebuilt(rows, out, length)
    assert sum(sum(n for _, n in w) < length for w in windows.values()) <= 24
    assert retrieval_packing.pack_documents(frame([]), TOKENIZER).count() == 0


def test_repeated_rows_are_all_packed(frame):
    out = retrieval_packing.pack_documents(frame([(1, "same words")] * 5 + [(2, None)] * 2), TOKENIZER).collect()
    assert sum(r.length for r in out) == 5 * 3 + 2 and sum(r.start == 0 for r in out) == 7


def test_neighbours_come_by_bm25(monkeypatch):
    rnd = random.Random(9)
    docs = [np.array([rnd.randrange(50) for _ in range(rnd.randint(0, 60))], np.uint16) for _ in range(90)]
    corpus = retrieval_packing.Corpus.__new__(retrieval_packing.Corpus)
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]).astype(int), minlength=50)
    corpus.documents, corpus.dtype = len(docs), np.dtype("<u2")
    corpus.idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5))
    corpus.mean = sum(map(len, docs)) / len(docs)

    def score(q, d):
        return sum(corpus.idf[t] * (d == t).sum() * 2.2 / ((d == t).sum() + 1.2 * (0.25 + 0.75 * len(d) / corpus.mean)) for t in set(q.tolist()))
    index, unused = retrieval_packing.Index(corpus, docs), np.array([rnd.random() < 0.9 for _ in docs])
    for q in docs[:20]:
        term = np.unique(q).astype(np.int64)
        want = {i: score(q, d) for i, d in enumerate(docs)}
        assert np.allclose(index.scores(term), [want[i] for i in range(len(docs))])
        got = list(index.ranked(term, unused))
        assert sorted(got) == np.flatnonzero(unused).tolist()
        assert all(want[a] > want[b] - 1e-9 for a, b in zip(got, got[1:]))
    packer = retrieval_packing.Packer(corpus, 256, 2, 0)
    packer.shard([(i, np.append(d, np.uint16(2))) for i, d in enumerate(docs)])
    packer.close()
    rows = sorted(packer.out, key=lambda r: (r[5], r[6]))
    ranked = [i for i in index.ranked(np.unique(docs[0]).astype(np.int64), np.ones(len(docs), bool)) if i != 0]
    assert rows[0][0] == 0 and [r[0] for r in rows[1:3]] == ranked[:2]


def test_word_table_is_seldom_copied_and_gives_the_tokenizer_ids(monkeypatch):
    words, copied, insert = retrieval_packing.Words(TOKENIZER), [], np.insert
    monkeypatch.setattr(np, "insert", lambda a, *rest: copied.append(len(a)) or insert(a, *rest))
    for block in range(200):
        texts = [f"word{block}x{i} again{i} Straße" for i in range(500)]
        raw = [t.encode() for t in texts]
        ids = words.of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        if block % 40 == 0:
            assert ids == words.encoded(texts)
    assert sum(copied) <= 12_000_000
