"""Of the classes of lines only those that lose a line reach the last join of line dedup."""

import numpy as np

from barwise.llm import line_dedup
from barwise.llm import textblocks as tb


def test_single_unmatched_lines_stay_out_of_the_last_join(frame, monkeypatch):
    held = {}

    def counted(df, name):
        out = written(df, name)
        held[name] = out.count()
        return out

    written = line_dedup.written
    monkeypatch.setattr(line_dedup, "written", counted)
    alone = [(i, "\n".join(f"line {j} of text {i} has words a{i}b{j} only here" for j in range(5))) for i in range(40)]
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [*alone, (100, "twice the very same line here\nother words"), (101, f"twice the very same line here\n{near}"), (102, f"{near} fifteen"), (None, None), (103, "")]
    got = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup.line_report(frame(rows)).collect()}
    assert got == {**{i: (5, []) for i in range(40)}, 100: (2, []), 101: (2, [0]), 102: (1, [0]), None: (0, []), 103: (1, [])}
    assert held["named"] == 2


def test_lines_and_words_by_unit():
    texts = ["", "a b\n\nc", "", "\n", " one\ttwo\n", "", "é\x1fx\x0by\x0e"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *(len(t.encode()) for t in texts)])[:-1]
    begin, row, number = tb.split_lines(data, starts)
    lines = [(i, n, x) for i, t in enumerate(texts) for n, x in enumerate(t.split("\n"))]
    assert [*zip(row.tolist(), number.tolist())] == [(i, n) for i, n, _ in lines]
    unit, word = tb.words(data, begin)
    counts = [len([w for w in x.replace("\t", " ").replace("\x0b", " ").split(" ") if w]) for *_, x in lines]
    assert np.bincount(unit, minlength=len(lines)).tolist() == counts
    assert len(word) == sum(counts)
