from __future__ import annotations

import pytest
from cases import empty_table, odd_rows, odd_table
from compare import connect, differences

from tideline.llm import lines
from tideline.llm.queries import op2_line_dedup
from tideline.llm.sql import oracles


def brute(rows):
    """rows (id, text) -> {(id, text): text left}."""
    places = {}
    distinct = sorted({(i is not None, i or 0, t, i) for i, t in rows if t is not None}, key=lambda x: (x[0], x[1]))
    for n, (_, _, text, _) in enumerate(distinct):
        found = text.split("\n")
        for p in range(len(found) - 2):
            if any(x.strip(" ") for x in found[p:p + 3]):
                places.setdefault(tuple(found[p:p + 3]), []).append((n, p))
    gone = {}
    for all_places in places.values():
        first = min(all_places)
        for n, p in all_places:
            if (n, p) != first:
                begin = max(p, first[1] + 3) if n == first[0] else p
                gone.setdefault(n, set()).update(range(begin, p + 3))
    return {(i, t): "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(n, ()))
            for n, (_, _, t, i) in enumerate(distinct)}


def test_sql(spark, folder):
    assert differences(spark, connect(folder), op2_line_dedup, oracles()["op2_line_dedup"], folder) is None


def test_odd_rows(spark):
    table = odd_table(spark)
    got = lines.dedup_lines(table).collect()
    assert len(got) == table.count()
    # Ids that repeat with other texts, and missing ones, are ordered by text hash, so only unique ids are compared.
    expected = brute([(r[0], r[1]) for r in odd_rows()])
    for r in got:
        if r.doc.text is None:
            assert r.text is None and r.n_lines == 0 and r.n_removed == 0
        else:
            assert r.text == expected[(r.doc.doc_id, r.doc.text)]
            assert r.n_lines == len(r.doc.text.split("\n"))
        assert r.doc.key == "x" and r.doc.removed == 3
    by = {r.doc.doc_id: r.text for r in got}
    assert by[2] == "" and by[3] == "own first line\nown last line" and by[9] == "A\nA\nA"


def test_empty(spark):
    assert lines.dedup_lines(empty_table(spark)).collect() == []


@pytest.mark.parametrize("text,left", [("a\nb\nc\na\nb\nc\n", "a\nb\nc\n"), ("\n\n\n\n\n", "\n\n\n\n\n"), ("a\nb", "a\nb")])
def test_one_document(spark, text, left):
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert [r.text for r in lines.dedup_lines(frame).collect()] == [brute([(1, text)])[(1, text)]] == [left]
