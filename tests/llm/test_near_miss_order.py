"""Near misses around a pivot that no other set matches meet only where rare edits are shared."""

import random

from barwise.llm import ngram_join
from barwise.llm.setjoin import Join, Sets
from barwise.session import scratch
from tests.llm.test_similarity import brute_groups


def edited(seed, n, size=150):
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    for i in range(n):
        text = list(base)
        for j in rnd.sample(range(size), rnd.choice([1, 2, 6, 12])):
            text[j] = f"x{i}y{j}"
        yield i, " ".join(text)


def test_few_candidates_around_a_pivot_without_matches(spark, frame):
    rows = list(edited(3, 120))
    # the pivot is far from all others: 20 words of its own
    pivot = " ".join(f"p{j}" if j % 7 == 0 else f"w{j}" for j in range(150))
    with scratch(spark):
        join = Join(frame([*rows, (1000, pivot)]), Sets(3, 90))
        node = {r["first"]["doc_id"]: r["node"] for r in join.members.select("first", "node").collect()}
        around = spark.createDataFrame([(node[1000], node[1000], x, x) for d, x in node.items() if d != 1000], "pivot long, home long, node long, g long")
        edits = ngram_join._rare_first(ngram_join._edits(join, around))
        got = {(r.a, r.b) for r in ngram_join._by_edits(edits, 90).collect()}
        back = {x: d for d, x in node.items()}
        sets = {d: {tuple(t.split()[i:i + 3]) for i in range(148)} for d, t in rows}
        match = {(a, b) for a in back for b in back if a < b and 1000 not in (back[a], back[b])
                 and 100 * len(sets[back[a]] & sets[back[b]]) >= 90 * len(sets[back[a]] | sets[back[b]])}
        assert match <= got, len(match - got)
        assert len(got) <= 2 * len(match), (len(got), len(match))


def test_same_groups_as_brute_force(frame):
    rows = list(edited(5, 60)) + list(edited(6, 10, 90))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_groups(frame(rows), 3, 90).collect()), key=str)
    assert got == brute_groups(rows, 3, 90)
