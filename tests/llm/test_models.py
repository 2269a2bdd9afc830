"""Language and quality models: held-out accuracy, and defined results for odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from cases import empty_table, odd_table

from tideline.llm import language, quality
from tideline.llm.common import crc32_mod_of, hash_share
from tideline.llm.queries import op1_language, op5_quality

BIG = "/root/testdata/sf0.01"


def brute_presence(text):
    """The n-grams themselves, without hashing."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower())
    while "  " in kept:
        kept = kept.replace("  ", " ")
    kept = kept if kept.startswith(" ") else " " + kept
    kept = kept if kept.endswith(" ") else kept + " "
    return {kept[i:i + n] for n in (1, 2, 3) for i in range(len(kept) - n + 1)}


def test_language_held_out(spark, folder):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    got = op1_language(spark, BIG).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (crc32_mod_of(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97


@pytest.mark.parametrize("text", ["Ein kurzer Satz, mit Umlaut: ä!", "a", "  12 x 34 y", "été " * 300, "日本語 한국어 𐐀𐐁"])
def test_presence_holds_the_blended_spectrum(text):
    found = language.presence(text)
    assert len(found) == len(brute_presence(text)) and found.all()


def test_presence_of_long_text_does_not_depend_on_steps(monkeypatch):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(5000))
    whole = language.presence(text)
    monkeypatch.setattr(language, "_STEP", 64)
    assert (language.presence(text) == whole).all()


def test_gram_table_finds_what_it_holds():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(1, 1 << 63, 3000, np.uint64) * np.uint64(2))
    crowded = np.append(values, np.arange(1, 900, dtype=np.uint64))  # all of these begin at one place
    table = language.GramTable(crowded)
    assert sorted(table.find(crowded).tolist()) == list(range(len(crowded)))
    assert len(table.find(np.arange(900, 5000, dtype=np.uint64))) == 0


def random_text(rng, first, letters, length):
    return "".join(map(chr, first + rng.integers(0, letters, length)))


def test_long_texts_of_large_alphabets(spark):
    """Texts hundreds of times longer than those learned from: right, and as sure as short ones."""
    rng = np.random.default_rng(6)
    kinds = {"zh": (0x4E00, 20_000), "ko": (0xAC00, 11_000)}
    rows = [(i, random_text(rng, *kinds[lang], 300), lang) for i in range(400) for lang in [("zh", "ko")[i % 2]]]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    for lang, (first, letters) in kinds.items():
        names, scores = model.decide([random_text(rng, first, letters, n) for n in (300, 5_000, 60_000, 200_000)])
        assert names == [lang] * 4 and scores.min() > 0.75


def test_equals_kernel_ridge_regression(spark):
    """With every text a landmark: regression on the whole kernel matrix, by the n-grams themselves."""
    rng = np.random.default_rng(2)
    rows = [(i, random_text(rng, 97 + 3 * (i % 3), 8, int(rng.integers(5, 60))), f"l{i % 3}") for i in range(60)]
    used = [(t, lang) for i, t, lang in rows if crc32_mod_of(i, 5)]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    sets = [brute_presence(t) for t, _ in used]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    inner = np.array([[kernel(a, b) for b in sets] for a in sets])
    y = np.array([[1.0 if lang == name else -1.0 for name in ("l0", "l1", "l2")] for _, lang in used])
    dual = np.linalg.solve(inner + language.RIDGE * len(used) * np.eye(len(used)), y)
    asked = [random_text(rng, 97 + 3 * (i % 3), 8, 40) for i in range(30)]
    names, scores = model.decide(asked)
    for text, name, score in zip(asked, names, scores):
        own = np.array([kernel(brute_presence(text), s) for s in sets])
        value = own @ dual / np.sqrt(own @ np.linalg.solve(inner, own))
        assert name == f"l{value.argmax()}" and score == pytest.approx(min(max((value.max() + 1) / 2, 0), 1), abs=1e-4)


def test_hot_language_and_repeated_rows(spark):
    """The sample of a language stays near its bound, whatever the number of rows and copies."""
    rows = [(i, f"ein text {i % 3000} mehr", "de") for i in range(9000)] + [(10_000 + i, "always the same text", "en") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(frame, per_language=200)
    assert model.languages == ["de", "en"]
    assert model.decide(["ein text 77 mehr", "the same"])[0] == ["de", "en"]


def test_language_odd_rows(spark):
    table = odd_table(spark)
    model = language.fit(table)
    assert model.languages == ["de", "en", "xx"]
    got = language.identify(table, model).collect()
    assert len(got) == table.count()
    by = {r.doc_id: r for r in got}
    for i in (4, 5, 6, 7):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert all(r.lang_pred in ("de", "en", "xx", "und") for r in got)


def test_language_empty(spark):
    model = language.fit(empty_table(spark))
    assert model.languages == []
    assert language.identify(empty_table(spark), model).collect() == []
    assert {r.lang_pred for r in language.identify(odd_table(spark), model).collect()} == {"und"}


def test_quality_held_out(spark, folder):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    got = op5_quality(spark, BIG).collect()
    assert len(got) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert all(r.held_out == (crc32_mod_of(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("rows,score", [
    ([], 0.5), ([(1, 1, 0), (2, 1, None), (3, 1, 0)], 1.0), ([(None, 1, 0), (1, None, 0), (8, 7, 0)], 0.5)])
def test_quality_without_two_kinds_of_labels(spark, rows, score):
    table = odd_table(spark)
    got = quality.score(table, quality.fit(table, labels_of(spark, rows))).collect()
    assert len(got) == table.count()
    assert {round(r.score, 2) for r in got} <= {score, round(score * 0.999, 2)}


def test_quality_odd_rows(spark):
    table = odd_table(spark)
    model = quality.fit(table, labels_of(spark, [(i, i % 2, 0) for i in range(1, 16)] + [(1, 1, 0), (1, 0, 0)]))
    got = quality.score(table, model).collect()
    assert len(got) == table.count() and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(table, model)
    assert kept.columns == table.columns
    assert sum(r.predicted for r in got) == kept.count()
    assert quality.keep_good(empty_table(spark), model).collect() == []


def plain_isotonic(points):
    """Non-decreasing shares by the min-max formula over (x, good, total), with block centres as knots."""
    share = lambda a, b: sum(p[1] for p in points[a:b]) / sum(p[2] for p in points[a:b])
    n = len(points)
    level = [max(min(share(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
    blocks = []
    for p, v in zip(points, level):
        if blocks and abs(blocks[-1][0] - v) < 1e-12:
            blocks[-1][1].append(p)
        else:
            blocks.append((v, [p]))
    knots = [sum(x * t for x, _, t in b) / sum(t for *_, t in b) for _, b in blocks]
    values = [(sum(g for _, g, _ in b) + 0.5) / (sum(t for *_, t in b) + 1) for _, b in blocks]
    return np.array(knots), np.maximum.accumulate(values)


def test_quality_equals_a_direct_solution(spark, folder):
    """The same features solved at once over all labelled rows, and calibrated by another form of isotonic regression."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    model = quality.fit(spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet"))
    ids = sorted(i for i in labels if crc32_mod_of(i, 3) != 1 and i in docs)
    parts = {r.id: r.part for r in spark.createDataFrame([(i,) for i in ids], "id bigint").select("id", hash_share("id", seed=8).alias("part")).collect()}
    stats = np.array([quality.statistics(docs[i]) for i in ids])
    good = np.array([labels[i] for i in ids], float)
    assert np.allclose(model.mean, stats.mean(0)) and np.allclose(model.scale, np.sqrt(np.maximum(stats.var(0), 1e-8)))
    waves = np.cos(np.clip((stats - stats.mean(0)) / model.scale, -5, 5) @ model.waves + model.shift) * np.sqrt(2 / quality.FOURIER)
    x = np.hstack([waves, np.ones((len(ids), 1))])
    fits = np.array([parts[i] >= quality.CALIBRATE for i in ids])
    # Ridge regression as least squares over the rows and one more row per weight.
    extra = np.sqrt(quality.RIDGE * len(ids) / x.shape[1]) * np.eye(x.shape[1])
    weights = np.linalg.lstsq(np.vstack([x[fits], extra]), np.append(good[fits], np.zeros(x.shape[1])), rcond=None)[0]
    assert np.allclose(model.weights, weights, atol=1e-6)
    raw = x[~fits] @ weights
    at = np.clip(((raw + 0.5) / 2 * quality.BINS).astype(int), 0, quality.BINS + 1)
    points = [(raw[at == b].mean(), good[~fits][at == b].sum(), (at == b).sum()) for b in np.unique(at)]
    knots, values = plain_isotonic(points)
    scores = np.clip(0.999 * np.interp(x @ weights, knots, values) + 0.001 * np.clip(x @ weights, 0, 1), 0, 1)
    assert np.allclose(model.score(stats), scores, atol=1e-6)


def test_quality_of_an_empty_table(spark):
    model = quality.fit(odd_table(spark), labels_of(spark, [(1, 1, 0), (2, 0, 0), (3, 1, 0), (5, 0, 0)]))
    assert quality.score(empty_table(spark), model).collect() == []
    empty = quality.fit(empty_table(spark), labels_of(spark, [(1, 1, 0), (2, 0, 0)]))
    assert {r.score for r in quality.score(odd_table(spark), empty).collect()} <= {0.5, 0.4995, 0.5005}


def test_isotonic_is_monotone_and_pools():
    x = np.arange(8.0)
    good = np.array([0, 2, 1, 0, 3, 2, 4, 4.0])
    knots, values = quality.isotonic(x, good, np.full(8, 4.0))
    assert (np.diff(values) >= 0).all() and (np.diff(knots) > 0).all() and len(values) < 8
