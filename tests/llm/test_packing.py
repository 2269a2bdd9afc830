from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import empty_table, odd_rows, odd_table
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import encoding, packing
from tideline.llm.queries import op8_packing, tokenizer_path

ODD = ["", "it's 'tis !!'s don't l'homme L'ÉTÉ", "a\tb\x1cc\x1c!", "<|endoftext|> x<|startoftext|>y <|STARTOFTEXT|>", "İstanbul! ΣΑΣ ẞ x²y Ⅷ 12345 a1b",
       "éte H̱a K", "日本語テキスト, नमस्ते दुनिया", "😀😀 ok fine　x", "É-Abc D_e", "a''s 'S x'S 'LL! “ſ 'ſ", "\x00\x01 ok", " " * 5 + "\n\n", "I'VE we're'nt"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def same_ids(tokenizer, texts, limit=encoding.CACHE):
    ids, counts = encoding.Encoder(tokenizer_path(), limit).batch(pa.array(texts, pa.string()))
    at = 0
    for text, count in zip(texts, counts.tolist()):
        assert ids[at:at + count].tolist() == ids_of(tokenizer, text)[:-1].tolist(), text
        at += count


def test_encoder_equals_the_tokenizer(tokenizer, spark, folder):
    same_ids(tokenizer, ODD)
    same_ids(tokenizer, ODD, limit=3)
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    same_ids(tokenizer, [*texts, None])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aBcsStl'’ \n\t!<|>_1²éÉßİſ̱́"), st.characters(exclude_categories=["Cs"])), max_size=25), min_size=1, max_size=3))
def test_encoder_on_any_text(tokenizer, texts):
    same_ids(tokenizer, texts)


def check(rows, texts, tokenizer, sequence=2048):
    """rows against texts [(doc_id, text)]: every document in order, every sequence gapless and within the limit."""
    pieces = sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    expected = []
    for i, text in texts:
        ids = ids_of(tokenizer, text)
        for piece, start in enumerate(range(0, len(ids), sequence)):
            part = ids[start:start + sequence]
            expected.append((i is not None, i or 0, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert pieces == sorted(expected)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return len(bins)


def test_query(spark, folder, tokenizer):
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    used = check(op8_packing(spark, folder).collect(), texts, tokenizer)
    assert used <= 1.01 * -(-sum(len(ids_of(tokenizer, t)) for _, t in texts) // 2048) + 1


def test_odd_rows(spark, tokenizer):
    rows = packing.pack(packing.pieces(odd_table(spark), tokenizer_path()), group=8).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows()], tokenizer)
    assert packing.pack(packing.pieces(empty_table(spark), tokenizer_path())).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [(2048, 2048, 2048**2), (2048, 3, 2048**2), (2048, 2048, 1_000_000)])
def test_best_fit_keeps_every_constraint(rule, capacity):
    rng = random.Random(1)
    lengths = np.array([rng.randint(1, 900) for _ in range(3000)])
    bins, offsets = packing.best_fit(lengths, capacity, rule=rule)
    for b in range(bins.max() + 1):
        own = lengths[bins == b]
        assert own.sum() <= capacity[0] and len(own) <= capacity[1] and (own**2).sum() <= capacity[2]
        order = np.argsort(offsets[bins == b])
        assert (offsets[bins == b][order] == np.cumsum(own[order]) - own[order]).all()
    bound = max(lengths.sum() / capacity[0], len(lengths) / capacity[1], (lengths**2).sum() / capacity[2])
    assert bins.max() + 1 <= 1.1 * bound + 1


def plain_best_fit(lengths, capacity, weights, rule):
    """The same choice by trying every bin for every piece."""
    cap, left, found = [float(c) for c in capacity], [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = [float(lengths[i]), 1.0, float(lengths[i]) ** 2]
        fits = [b for b, room in enumerate(left) if all(r >= x for r, x in zip(room, need))]

        def cost(b):
            if rule == "norm":
                return sum(w * ((r - x) / c) ** 2 for w, r, x, c in zip(weights, left[b], need, cap))
            return -sum(w * r * x / c**2 for w, r, x, c in zip(weights, left[b], need, cap))

        best = min((cost(b) for b in fits), default=None)
        # Costs that differ by rounding alone are one cost; the oldest bin has it.
        b = next((b for b in fits if cost(b) <= best + 1e-12), None) if fits else None
        if b is None:
            b = len(left)
            left.append(cap[:])
        found[i] = (b, cap[0] - left[b][0])
        left[b] = [r - x for r, x in zip(left[b], need)]
    return [found[i] for i in range(len(lengths))]


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [(64, 64, 64**2), (64, 4, 64**2), (64, 64, 1500)])
def test_best_fit_equals_a_plain_one(rule, capacity):
    rng = random.Random(3)
    for n in (0, 1, 40, 250):
        lengths = np.array([rng.randint(1, 38) for _ in range(n)], np.int64)
        bins, offsets = packing.best_fit(lengths, capacity, rule=rule)
        assert list(zip(bins.tolist(), offsets.tolist())) == plain_best_fit(lengths.tolist(), capacity, (1.0, 0.05, 0.05), rule)
