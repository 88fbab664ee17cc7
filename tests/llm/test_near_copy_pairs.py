"""near_copies gives all matching pairs, exact_copies every row's representative."""

import random

from barwise.llm import fingerprints


def test_all_pairs_and_members(frame):
    rnd = random.Random(4)
    base = [f"word{rnd.randrange(900)}" for _ in range(120)]
    texts = [" ".join(base[:i] + [f"new{i}"] + base[i + 1:]) for i in range(0, 120, 10)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(50, texts[0]), (None, texts[3]), (60, "only exact copies are here now"), (61, "only exact copies are here now"),
                                                    (None, " ".join(base)), (70, None), (71, "")]

    def s(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    nodes = [(i, t) for i, t in enumerate(texts)] + [(None, " ".join(base))]
    want = {frozenset((a, b)): len(s(t) & s(u)) / len(s(t) | s(u)) for i, (a, t) in enumerate(nodes) for b, u in nodes[:i]
            if 100 * len(s(t) & s(u)) >= 80 * len(s(t) | s(u))}
    got = [(frozenset((r.doc_id, r.other_id)), r.jaccard) for r in fingerprints.near_copies(frame(rows)).collect()]
    assert len(want) == 78 and len(got) == len(want) and dict(got) == want
    members = sorted(((r.doc_id, r.representative) for r in fingerprints.exact_copies(frame(rows)).collect()), key=str)
    assert members == sorted([*((i, i) for i in range(12)), (50, 0), (None, 3), (60, 60), (61, 60), (None, None), (70, 70), (71, 71)], key=str)
