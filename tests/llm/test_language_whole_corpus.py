"""The pipeline's language stage learns its model and its typical values from every labelled row."""

import random
import tracemalloc
import zlib

import numpy as np

from barwise.llm import langid

GREEK = [chr(x) for x in range(0x3B1, 0x3CA)] + [" "] * 4


def texts(letters, n, seed, length=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(5, length))) for _ in range(n)]


def own_counts(text):
    own = np.zeros(1 << langid.BITS, np.int64)
    for row, point in langid._blocks([text]):
        for _, bucket in langid.grams(row, point):
            own += np.bincount(bucket, minlength=1 << langid.BITS)
    return own


def test_typical_values_come_from_all_rows(spark, frame):
    rows = [(t, "aa") for t in texts("abcdefgh ", 3100, 1)] + [(t, "el") for t in texts(GREEK, 1500, 2)] + [("12 3", "aa"), (None, "el"), ("abc", None)]
    labelled = frame(rows, "text string, lang string")
    names, table = langid.counted(labelled)
    got = langid.typical(labelled, names, table)
    total = table[:-1].sum(axis=0)
    for k, name in enumerate(names):
        means, spreads = [], []
        for text, lang in rows:
            if lang == name and text:
                own = own_counts(text)
                at, n = np.flatnonzero(own), own.sum()
                if n:
                    p = np.log(table[at, k] - own[at] + langid.SMOOTHING) - np.log(total[k] - n + langid.SMOOTHING * (1 << langid.BITS))
                    means.append((p * own[at]).sum() / n)
                    spreads.append((((p - means[-1]) ** 2) * own[at]).sum() / n)
        assert abs(got[k, 0] - np.median(means)) <= 0.5 * 10 ** -langid.DECIMALS + 1e-9
        assert np.allclose(got[k, 1:], [np.var(means), 4 * np.mean(spreads)], rtol=1e-9)


def test_a_language_of_held_out_documents_alone_is_learned(spark, frame):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 4 == 2][:40]
    rest = [i for i in range(4000) if i not in set(ids)][:200]
    rows = list(zip(rest, texts("abcdefgh ", 200, 3, 200), ["aa"] * 200)) + list(zip(ids, texts(GREEK, 40, 4, 200), ["el"] * 40))
    kept = {r.doc_id for r in langid.accepted(frame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == {r[0] for r in rows}


def test_a_long_text_needs_little_memory_at_a_time():
    langid._letters()
    text = "".join(texts("abcdefgh ", 1, 5)) * 1
    text = (text * (1 + (1 << 20) // len(text)))[: 1 << 20]
    tracemalloc.start()
    n = sum(len(r) for row, point in langid._blocks([text]) for r, _ in langid.grams(row, point))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 2 << 20 and peak < 20 << 20
