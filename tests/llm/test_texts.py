"""License scan, digests and chat formatting."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pytest
from cases import ascii_lower, empty_table, odd_rows, odd_table
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import chat, digest, licenses
from tideline.llm.queries import op3_licenses, op6_fingerprint, op9_chat
from tideline.llm.sql import oracles


def test_licenses_sql(spark, folder):
    assert differences(spark, connect(folder), op3_licenses, oracles()["op3_licenses"], folder) is None


def brute_base(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    found = [(i, label) for phrase, label in licenses.BASE for p in [phrase.split()]
             for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return words, found


def check_base(r, text):
    words, found = brute_base(text)
    starts = [i for i, _ in found]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
        len(words), len(found), min(starts, default=None), max(starts, default=None))
    assert r.base_labels == ",".join(sorted({label for _, label in found}))
    assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_licenses_odd_rows(spark):
    table = odd_table(spark)
    got = licenses.scan(table).collect()
    assert len(got) == table.count()
    texts = {r[0]: r[1] for r in odd_rows() if r[0] not in (None, 12, 13)}
    for r in got:
        if r.doc_id in texts:
            check_base(r, texts[r.doc_id])
    assert licenses.scan(empty_table(spark)).collect() == []


def test_licenses_spans(spark):
    bsd = next(p for p, label in licenses.NOTICES if label == "bsd")
    words = bsd.split()
    texts = ["Intro. " + bsd.upper() + " outro", " ".join(words[:7] + ["strange"] + words[7:]), " ".join(words[:6]),
             " ".join(reversed(words)), "cc by nc " * 3 + "cc by", "cc-by-nc Under The MIT license, under the MIT license"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        check_base(got[i], text)
    assert [got[i].labels for i in range(4)] == ["bsd", "bsd", "", ""]
    assert got[1].score < got[0].score == 1.0
    assert got[4].n_base == 3 and got[5].labels == "cc-by-nc,mit"


def plain_digest(text):
    """The digest by its definition, byte by byte: (quartile of each bucket, length class)."""
    data, counts, wrap = text.encode(), [0] * 256, 1 << 32
    for p in range(len(data)):
        for k, (i, j) in enumerate([(1, 2), (1, 3), (2, 3), (1, 4)]):
            if p + j < len(data):
                mixed = data[p] * 0x9E3779B1 % wrap ^ data[p + i] * 0x85EBCA77 % wrap ^ data[p + j] * 0xC2B2AE3D % wrap
                counts[(mixed + k * 0x27D4EB2F) * 0x165667B1 % wrap >> 24] += 1
    ordered = sorted(counts)
    return [sum(c > ordered[q] for q in (63, 127, 191)) for c in counts], min(int(math.log(len(data) + 1) / math.log(1.1)), 255)


def plain_hex(found):
    quartiles, size = found
    return f"{size:02x}" + "".join(f"{a << 6 | b << 4 | c << 2 | d:02x}" for a, b, c, d in zip(*[iter(quartiles)] * 4))


def plain_likeness(a, b):
    cost = sum((0, 1, 3, 6)[abs(x - y)] for x, y in zip(a[0], b[0])) + 4 * min(abs(a[1] - b[1]), 32)
    return 1 - cost / (6 * 256 + 4 * 32)


def test_long_notices(spark):
    """A whole license in its usual layout, with a few words changed, and one that stops half way."""
    mit = next(p for p, label in licenses.NOTICES if label == "mit-full").split()
    isc = next(p for p, label in licenses.NOTICES if label == "isc").split()
    changed = mit[:40] + ["ONE", "MORE"] + mit[40:90] + mit[91:]
    texts = ["(c) 2024 somebody\n\n" + ", ".join(changed).upper() + ".", " ".join(isc[:len(isc) // 2]), " ".join(mit[:30] + isc[-40:])]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert "mit-full" in got[0].labels.split(",") and 0.8 <= got[0].score <= 1
    assert got[1].labels == "" and "mit-full" not in got[2].labels and "isc" not in got[2].labels.split(",")


def brute_pairs(rows):
    """rows (id, text) with unique ids."""
    rows = sorted(rows)
    digests = {i: plain_digest(t) for i, t in rows}
    for (i, a), (n, b) in zip(rows, rows[1:] + rows[:1]):
        half = len(a) // 2
        new = a[:len(a) - half] + b[:half]
        changed = plain_digest(new)
        yield (i, len(a), hashlib.sha256(new.encode()).hexdigest(), plain_hex(digests[i]), plain_hex(changed),
               pytest.approx(plain_likeness(digests[i], changed)), pytest.approx(plain_likeness(digests[i], digests[n])))


@pytest.mark.parametrize("rows_per_range", [2000, 7])
def test_digest_pairs(spark, folder, monkeypatch, rows_per_range):
    monkeypatch.setattr(digest, "ROWS_PER_RANGE", rows_per_range)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t[:3000]) for i, t in rows]
    got = digest.fingerprint_pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in got) == list(brute_pairs(rows))


def test_digest_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = op6_fingerprint(spark, folder).collect()
    assert len(got) == len(texts) and all(r.n_chars == len(texts[r.doc_id]) for r in got)
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    assert sum(r.near_edited > r.near_next for r in got) > 0.95 * len(got)
    longest = max(got, key=lambda r: r.n_chars)
    assert longest.fingerprint == plain_hex(plain_digest(texts[longest.doc_id]))


def test_an_id_of_many_rows_has_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(digest, "ROWS_PER_RANGE", 20)
    rows = [(None if n % 2 else 7, f"{n} is the text's number") for n in range(400)] + [(i, f"{i} own") for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.edited_sha256) for r in digest.fingerprint_pairs(frame).collect())
    order = sorted((r.doc_id is not None, r.doc_id or 0, r.h, r.text) for r in frame.select("*", F.xxhash64("text").alias("h")).collect())
    halves = [(len(a[3]) // 2, a, b) for a, b in zip(order, order[1:] + order[:1])]
    assert got == sorted((*a[:2], hashlib.sha256((a[3][:len(a[3]) - n] + b[3][:n]).encode()).hexdigest()) for n, a, b in halves)
    cuts = np.array([-5, 3, 3, 3, 3, 9])
    at, h = np.array([-9, 3, 3, 3, 4, 10]), np.array([0, -(1 << 63), 0, (1 << 63) - 1, 5, 5])
    assert digest._range_of(cuts, at, h).tolist() == [0, 1, 3, 4, 5, 6]


@pytest.mark.parametrize("rows_per_range", [2000, 2])
def test_digest_odd_rows(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(digest, "ROWS_PER_RANGE", rows_per_range)
    got = digest.fingerprint_pairs(odd_table(spark)).collect()
    assert len(got) == len(odd_rows())
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, []).append(r.fingerprint)
    assert prints[1] == prints[2] and prints[4] == prints[5] and prints[12][0] == prints[12][1]
    assert digest.fingerprint_pairs(empty_table(spark)).collect() == []
    single = digest.fingerprint_pairs(spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")).collect()
    assert [(r.edited_sha256, r.near_next) for r in single] == [(hashlib.sha256(b"abcabc").hexdigest(), 1.0)]


def test_likeness_is_bounded_and_symmetric():
    a, b, c = (digest.digest(t) for t in ("", "a completely different text " * 20, "\x00" * 100_000))
    for x in (a, b, c):
        assert digest.likeness(x, x) == 1.0
        for y in (a, b, c):
            assert 0 <= digest.likeness(x, y) == digest.likeness(y, x) <= 1


def test_chat_sql(spark, folder):
    assert differences(spark, connect(folder), op9_chat, oracles()["op9_chat"], folder) is None


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "[INST] hi </s>"), (1, 2, "assistant", "\\1 \\\\ <s>[/INST]"), (1, 3, "user", "?"),
    (1, 4, "assistant", ""), (2, 0, "user", "only a user"), (3, 1, None, None), (3, None, "assistant", "first, without a number"),
    (4, 0, "odd\nrole [<\\3", "x\ny"), (4, 0, "assistant", "same number"), (4, 0, "assistant", "same number"), (None, 0, "assistant", "no id"),
    (5, 0, "assistant", "a\n" * 30_000), (5, 1, "user", None)]


def brute_chat(rows):
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in talks.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        yield conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark):
    frame = spark.createDataFrame([(*r, "extra") for r in TURNS], "conv_id bigint, turn bigint, role string, text string, example string")
    made = chat.examples(frame)
    got = {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(made).collect()}
    assert got == set(brute_chat(TURNS))
    first = [r for r in made.collect() if r.conv_id == 1]
    assert [(r.example, r.trainable) for r in sorted(first)] == [(0, True), (1, True)]
    assert chat.examples(frame.limit(0)).collect() == [] and chat.read_back(chat.examples(frame.limit(0))).collect() == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>", "a\nb"]), st.text(alphabet="\\[]</s>INT0123 \nxé", max_size=12)),
                min_size=1, max_size=6))
def test_chat_round_trip_of_any_text(spark, turns):
    rows = [(1, n, role, text) for n, (role, text) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.examples(frame)).collect()}
    assert got == set(brute_chat(rows))
