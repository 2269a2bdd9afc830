from __future__ import annotations

import json
import zlib

import numpy as np
import pytest
from cases import empty_table, odd_rows, odd_table

from tideline.llm import tokenfiles
from tideline.llm.queries import op13_token_files, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_query(spark, folder, tokenizer):
    texts = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    start, expected = 0, []
    for i, text in texts:
        ids = ids_of(tokenizer, text)
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = op13_token_files(spark, folder)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 4
    assert sorted(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("partitions", [None, 1, 5])
def test_files_of_odd_rows(spark, tokenizer, tmp_path, partitions):
    folder = str(tmp_path / "out")
    manifest = tokenfiles.write(odd_table(spark), folder, tokenizer_path(), partitions=partitions)
    assert manifest == json.loads((tmp_path / "out" / "manifest.json").read_text()) == tokenfiles.read_manifest(folder)
    rows = sorted(tokenfiles.read(spark, folder).collect(), key=lambda r: r.start)
    names = [r.doc_id for r in rows]
    assert names == sorted(names, key=lambda i: (i is not None, i or 0)) and len(rows) == len(odd_rows()) == manifest["documents"]
    files = tokenfiles.TokenFiles(folder)
    assert len(files) == len(rows)
    at, stream = 0, []
    for n, row in enumerate(rows):
        ids = files.document(n).tolist()
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        stream += ids
    assert at == manifest["tokens"]
    by_id = {}
    for name, n in zip(names, range(len(rows))):
        by_id.setdefault(name, []).append(files.document(n).tolist())
    for name, found in by_id.items():
        assert sorted(found) == sorted(ids_of(tokenizer, r[1]) for r in odd_rows() if r[0] == name)
    for start, length in [(0, 5), (3, 40), (at - 2, 10), (at, 3), (0, at)]:
        assert files.span(start, length).tolist() == stream[start:start + length]
    flat = b"".join((tmp_path / "out" / f"{s['shard']}.ids").read_bytes() for s in manifest["shards"])
    assert np.frombuffer(flat, "<u2").tolist() == stream
    if partitions == 5:
        assert len(manifest["shards"]) > 1


def test_a_repeated_id_is_dealt_to_many_shards(spark, tmp_path):
    rows = [(None if i % 2 else 7, f"text {i % 5}") for i in range(400)]
    manifest = tokenfiles.write(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "out"), tokenizer_path(), partitions=8)
    assert len(manifest["shards"]) == 8 and max(s["documents"] for s in manifest["shards"]) < 120


def test_stray_files_go_and_an_empty_table_has_no_shard(spark, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "shard-000001-lost.ids").write_bytes(b"xx")
    manifest = tokenfiles.write(empty_table(spark), str(tmp_path / "out"), tokenizer_path())
    assert manifest["shards"] == [] and [p.name for p in (tmp_path / "out").iterdir()] == ["manifest.json"]
    assert tokenfiles.read(spark, str(tmp_path / "out")).collect() == []
    assert len(tokenfiles.TokenFiles(str(tmp_path / "out"))) == 0
