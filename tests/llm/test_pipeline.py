"""The pipeline's stages against brute-force versions, each on its own input."""

from __future__ import annotations

from collections import Counter

import pytest
from cases import odd_table
from test_lines import brute as brute_lines
from test_packing import check as check_packing
from test_simhash import brute_components, brute_print

import corpus_pipeline
from tideline.llm import quality
from tideline.llm.common import table
from tideline.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows before and after every stage."""
    out = tmp_path_factory.mktemp("stages")
    docs, found = table(spark, folder, "documents"), []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{out}/{n}")
        after = spark.read.parquet(f"{out}/{n}")
        found.append((docs, after))
        docs = after
    return found


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(spark, folder, stages):
    before, after = stages[0]
    model = quality.fit(before, table(spark, folder, "labels"))
    scores = quality.score(before, model).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores if r.predicted}
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    kept = {r.doc_id for r in after.collect()}
    good = [i for i, q in labels.items() if q]
    assert sum(i in kept for i in good) >= 0.95 * len(good)


def test_line_dedup(stages):
    before, after = (x.collect() for x in stages[1])
    expected = brute_lines([(r.doc_id, r.text) for r in before])
    rows = {r.doc_id: r for r in before}
    want = {i: left for (i, text), left in expected.items() if left != "" or text == "" }
    got = {r.doc_id: r for r in after}
    assert {i: r.text for i, r in got.items()} == want
    for i, r in got.items():
        assert r.n_chars == (len(r.text) if r.text != rows[i].text else rows[i].n_chars)


def test_near_dedup(stages):
    before, after = (x.collect() for x in stages[2])
    roots = brute_components({r.doc_id: brute_print(r.text) for r in before})
    assert Counter(r.doc_id for r in after) == Counter(set(roots.values()))
    texts = {r.doc_id: r for r in before}
    assert all(r == texts[r.doc_id] for r in after)


def test_mixing(spark, stages):
    from tideline.llm.mixing import mix

    before, after = stages[3]
    want = {r.doc_id: r.repeats for r in mix(before).collect() if r.repeats}
    assert Counter(r.doc_id for r in after.collect()) == Counter(want)


def test_packing(spark, stages):
    from tokenizers import Tokenizer

    before, after = (x.collect() for x in stages[4])
    check_packing(after, [(r.doc_id, r.text) for r in before], Tokenizer.from_file(tokenizer_path()))


def test_run_gives_the_same_pieces(spark, folder, stages):
    pieces = lambda rows: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert pieces(corpus_pipeline.run(spark, folder).collect()) == pieces(stages[4][1].collect())


def test_odd_rows_pass_through(spark, folder):
    docs = odd_table(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd_table(spark).columns
        docs.collect()
