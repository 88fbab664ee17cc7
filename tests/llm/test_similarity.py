"""N-gram Jaccard join and line dedup against brute force."""

import random
import re

import pytest

from barwise.llm import line_dedup, ngram_join
from barwise.llm.components import components

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def shingles(text, k):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def alike(a, b, percent):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def brute_groups(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j], percent) and top(i) != top(j):
                group[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(sets[i]), least.get(top(i), d)) for i, (d, _) in enumerate(rows)), key=str)


def brute_lines(rows, k, percent):
    lines = sorted(((-1 if d is None else d), d, i, n, shingles(x, k)) for i, (d, t) in enumerate(rows)
                   for n, x in enumerate((t or "").split("\n")) if words(x))
    gone = {}
    for a, line in enumerate(lines):
        if any(alike(line[4], b[4], percent) for b in lines[:a]):
            gone.setdefault(line[2], []).append(line[3])
    return sorted(((d, sorted(gone.get(i, []))) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(seed, n=60, size=40):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(vocabulary) for _ in range(size)] for _ in range(4)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((i * 3, " ".join(w) + rnd.choice(["", " tail", "\nand one more line of words"])))
    return rows


EDGE = [(7, None), (8, ""), (9, " \n\t "), (10, "One"), (11, "one"), (12, "one two"), (3, "ONE  two"), (13, "x" * 300_000 + " y z"),
        (14, "x" * 300_000 + " y z"), (None, "one two"), (None, "lonely words here"), (14, "x" * 300_000 + " y z"), (15, "one two three é É"),
        (16, "one two three é é")]


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_groups_equal_brute_force(spark, frame, k, percent):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for rows in (real, near_copies(k), EDGE):
        got = ngram_join.near_groups(frame(rows), k, percent).drop("text_key").collect()
        assert sorted(map(tuple, got), key=str) == brute_groups(rows, k, percent)


def test_groups_of_an_empty_table(frame):
    assert ngram_join.near_groups(frame([])).count() == 0
    assert ngram_join.one_of_each(frame([])).count() == 0


def test_one_of_each_keeps_all_columns_and_one_row(frame):
    rows = [(5, "a b c d e f", "p"), (5, "a b c d e f", "q"), (6, "a b c d e f", "r"), (7, "other words are found here now", "s"), (8, None, "t"), (None, "a b c d e f", "u")]
    out = ngram_join.one_of_each(frame(rows, "doc_id long, text string, node string")).collect()
    assert sorted(str(r.doc_id) for r in out) == ["5", "7", "8", "None"]
    assert out[0].__fields__ == ["doc_id", "text", "node"]


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_lines_equal_brute_force(spark, frame, seed):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for rows in (real[seed::2], near_copies(seed), [r for r in EDGE if r != (14, EDGE[8][1])]):
        got = line_dedup.line_report(frame(rows)).collect()
        assert sorted(((r.doc_id, r.removed) for r in got), key=str) == brute_lines(rows, 5, 80)


def test_dedup_lines_text(frame):
    line, other = "the same five words and more", "another line that has enough words"
    rows = [(1, f"{line}\nshort\n{other}", 9), (2, f"start\n{line}\n\nend", 9), (3, line, 9), (4, None, 9), (5, "", 9)]
    out = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.dedup_lines(frame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert out == {1: (rows[0][1], 9), 2: ("start\n\nend", 10), 4: (None, 9), 5: ("", 9)}
    assert line_dedup.dedup_lines(frame([])).count() == 0


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def crowd(seed, size, members, strangers, kin):
    """Near copies of one text, texts that just miss it, and some that differ from a near miss by little."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(size)]

    def edited(text, edits):
        text = list(text)
        for at in rnd.sample(range(size), edits):
            text[at] = f"x{rnd.randrange(10 ** 9)}"
        return text

    near = [edited(base, rnd.choice([0, 1, 2, 3])) for _ in range(members)]
    far = [edited(base, max(1, size * 12 // 1000 + rnd.choice([0, 1, 2, 3]))) for _ in range(strangers)]
    more = [edited(rnd.choice(far), rnd.choice([1, 2, 3])) for _ in range(kin)]
    cut = [t[rnd.randrange(6):size - rnd.randrange(6)] for t in rnd.sample(near + far + more, 20)]
    rows = near + far + more + cut
    rnd.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("seed,size,k,percent", [(1, 200, 3, 90), (2, 300, 5, 80), (3, 120, 3, 90)])
def test_crowded_groups_equal_brute_force(frame, seed, size, k, percent):
    rows = crowd(seed, size, 60, 60, 40)
    got = ngram_join.near_groups(frame(rows), k, percent).drop("text_key").collect()
    assert sorted(map(tuple, got), key=str) == brute_groups(rows, k, percent)
