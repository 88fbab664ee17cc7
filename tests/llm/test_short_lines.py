"""Line dedup of lines that are shorter than a shingle, against brute force."""

import pytest

from barwise.llm import line_dedup
from test_similarity import EDGE, SF, alike, near_copies, shingles, words


def brute(rows, k=5, percent=80):
    lines = sorted(((-1 if d is None else d), d, i, n, shingles(x, k)) for i, (d, t) in enumerate(rows)
                   for n, x in enumerate((t or "").split("\n")) if words(x))
    gone = {}
    for a, line in enumerate(lines):
        if any(alike(line[4], b[4], percent) for b in lines[:a]):
            gone.setdefault(line[2], []).append(line[3])
    return sorted(((d, sorted(gone.get(i, []))) for i, (d, _) in enumerate(rows)), key=str)


def test_repeats_of_short_lines_go(frame):
    rows = [(1, "All rights reserved.\nx\n\nfour words are here"), (2, "ALL  rights reserved.\n\nall rights"), (3, "x\nx\nfour words are here now"), (4, " x ")]
    out = {r.doc_id: r.removed for r in line_dedup.line_report(frame(rows)).collect()}
    assert out == {1: [], 2: [0], 3: [0, 1], 4: [0]}
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(rows)).collect()}
    assert left == {1: rows[0][1], 2: "\nall rights", 3: "four words are here now"}


@pytest.mark.parametrize("seed", [1, 2])
def test_all_lines_equal_brute_force(spark, frame, seed):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for rows in (real[seed::2], near_copies(seed), [r for r in EDGE if r != (14, EDGE[8][1])]):
        got = line_dedup.line_report(frame(rows)).collect()
        assert sorted(((r.doc_id, r.removed) for r in got), key=str) == brute(rows)
