from __future__ import annotations

import collections

import cases

from tickloom.llm.lines import dedup_lines


def expected(rows, min_chars=10, min_documents=2):
    last = 2**63 - 1
    key = lambda line: cases.ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    held = collections.defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(last if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines, own = (text or "").split("\n"), last if doc_id is None else doc_id
        kept = [
            x
            for x in lines
            if len(key(x)) < min_chars or len(held[key(x)]) < min_documents or own == min(held[key(x)])
        ]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def result(df):
    return cases.rows_of(df.select("doc_id", "lines.kept", "lines.n_lines", "lines.n_dropped"))


def test_odd_rows(spark):
    rows = [r[:2] for r in cases.ROWS]
    assert result(dedup_lines(cases.documents(spark))) == expected(rows)


def test_higher_threshold_and_shorter_lines(spark):
    rows = [(i, f"one\ncommon line\nown {i}\n" + ("rare line\n" if i < 2 else "")) for i in range(4)]
    docs = cases.documents(spark, [(*r, "en", "a", 0) for r in rows])
    got = result(dedup_lines(docs, min_chars=3, min_documents=3))
    assert got == expected(rows, 3, 3)
    assert got[3][1] == "own 3\n"


def test_empty_table_and_clashing_columns(spark):
    assert dedup_lines(cases.none(spark)).count() == 0
    docs = cases.documents(spark, clashing=True)
    out = dedup_lines(docs)
    assert result(out) == expected([r[:2] for r in cases.ROWS])
    assert [r["size"] for r in out.select("size").distinct().collect()] == ["size"]


def test_very_long_text_loses_every_second_line(spark):
    shared = [f"a line that is shared {i}" for i in range(3000)]
    first = "\n".join(shared)
    second = "\n".join(x for i, s in enumerate(shared) for x in (s, f"own {i}"))
    rows = [(1, first), (2, second)]
    docs = cases.documents(spark, [(*r, "en", "a", 0) for r in rows])
    assert result(dedup_lines(docs)) == expected(rows)
