"""Token ids as flat binary files that training code memory-maps.

A written folder holds, for every shard,

* `<shard>.ids`: the ids of its documents one after the other, unsigned little-endian integers of 2 bytes (4 if the
  vocabulary needs them), each document closed by the end id;
* `<shard>.offsets`: unsigned 64-bit numbers, one more than documents: where each document begins in the shard, and the end;
* `<shard>.docs`: the signed 64-bit ids of its documents; those without an id come first, as zeros;

and `manifest.json`, which is written last and names the shards in order with the number of documents and tokens before
each. These bases are prefix sums over the shards, so no task has to wait for another one.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import ensure_checkpoint_dir, saved, text_chunks
from tideline.llm.encoding import CHUNK, encoder

END_ID = 1
MANIFEST = "manifest.json"
# Documents that are read back together.
READ = 4096


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder: a plain path, or file:, hdfs:, s3: or gs: for what is no mounted disk."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[5:]
    return pafs.FileSystem.from_uri(folder)


def _mapped(files: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    """The numbers of a file: memory-mapped from a disk, else read."""
    if not files.get_file_info(path).size:
        return np.zeros(0, kind)
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), kind)


class _Shard:
    """One shard while it is written. Its name is new for every attempt of a task, so attempts never mix."""

    def __init__(self, folder: str, part: int, kind: str):
        self.files, path = _store(folder)
        self.files.create_dir(path, recursive=True)
        self.name, self.part, self.kind = f"shard-{part:06d}-{uuid.uuid4().hex}", part, kind
        self.out = {end: self.files.open_output_stream(f"{path}/{self.name}.{end}") for end in ("ids", "offsets", "docs")}
        self.out["offsets"].write(np.zeros(1, "<u8"))
        self.documents = self.tokens = self.nulls = 0

    def add(self, names: pa.Array, ids: np.ndarray, counts: np.ndarray, end_id: int) -> None:
        ends = np.cumsum(counts + 1)
        flat = np.full(int(ends[-1]), end_id, self.kind)
        own = np.ones(len(flat), bool)
        own[ends - 1] = False
        flat[own] = ids
        self.out["ids"].write(flat)
        self.out["offsets"].write((ends + self.tokens).astype("<u8"))
        self.out["docs"].write(names.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.documents += len(counts)
        self.tokens += len(flat)
        self.nulls += names.null_count

    def close(self) -> pa.RecordBatch:
        for out in self.out.values():
            out.close()
        return pa.RecordBatch.from_pydict({"part": [self.part], "shard": [self.name], "documents": [self.documents],
                                           "tokens": [self.tokens], "nulls": [self.nulls]})


def write(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          partitions: int | None = None) -> dict:
    """Encode every whole text, in ascending order of the id, and write the files. Returns the manifest.

    A NULL text counts as empty: its one id is end_id. NULL ids come first. Documents of one id are ordered by a hash of
    the text, repeated rows follow each other, and neither has to fit into one task. An empty table gives a manifest
    without shards. `folder` has to be new and in reach of all executors.
    """
    kind = "<u2" if max(encoder(tokenizer).size, end_id + 1) <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("nth"))
    order = ["doc_id", "h", "nth"]
    dealt = rows.repartitionByRange(*order) if partitions is None else rows.repartitionByRange(partitions, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encode = None, encoder(tokenizer).batch
        for whole in batches:
            for begin, stop in text_chunks(whole, 1, CHUNK):
                batch = whole.slice(begin, stop - begin)
                shard = shard or _Shard(folder, TaskContext.get().partitionId(), kind)
                shard.add(batch.column(0), *encode(batch.column(1)), end_id)
        if shard is not None:
            yield shard.close()

    # Kept, so that no later read runs the encoding again; it names the files of those attempts that ended well.
    done = saved(dealt.sortWithinPartitions(*order).select("doc_id", "text")
                 .mapInArrow(run, "part bigint, shard string, documents bigint, tokens bigint, nulls bigint"))
    shards = [r.asDict() for r in done.orderBy("part").collect()]
    documents = tokens = 0
    for shard in shards:
        shard |= {"first_document": documents, "first_token": tokens}
        documents, tokens = documents + shard["documents"], tokens + shard["tokens"]
    manifest = {"dtype": kind, "end_id": end_id, "documents": documents, "tokens": tokens, "shards": shards}
    files, path = _store(folder)
    files.create_dir(path, recursive=True)
    named = {s["shard"] for s in shards}
    for info in files.get_file_info(pafs.FileSelector(path)):
        if info.base_name.startswith("shard-") and info.base_name.split(".")[0] not in named:
            files.delete_file(info.path)  # of an attempt that was lost
    with files.open_output_stream(f"{path}/{MANIFEST}") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    files, path = _store(folder)
    with files.open_input_file(f"{path}/{MANIFEST}") as file:
        return json.loads(file.read())


class TokenFiles:
    """Random access to a written folder: documents by their place, and spans of the whole stream of tokens."""

    def __init__(self, folder: str):
        self.files, self.path = _store(folder)
        self.manifest = read_manifest(folder)
        self.shards = self.manifest["shards"]

    def __len__(self) -> int:
        return self.manifest["documents"]

    @cached_property
    def _open(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [tuple(_mapped(self.files, f"{self.path}/{s['shard']}.{end}", kind)
                      for end, kind in (("ids", self.manifest["dtype"]), ("offsets", "<u8"))) for s in self.shards]

    def _shard_of(self, key: str, value: int) -> int:
        return int(np.searchsorted([s[key] for s in self.shards], value, "right")) - 1

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, with the end id."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = self._shard_of("first_document", i)
        ids, offsets = self._open[k]
        i -= self.shards[k]["first_document"]
        return ids[int(offsets[i]):int(offsets[i + 1])]

    def span(self, start: int, length: int) -> np.ndarray:
        """Ids from place `start` of the whole stream on, also across documents and shards."""
        stop = min(start + length, self.manifest["tokens"])
        found, k = [], max(self._shard_of("first_token", start), 0)
        while start < stop:
            base = self.shards[k]["first_token"]
            part = self._open[k][0][start - base:stop - base]
            found.append(part)
            start, k = start + len(part), k + 1
        return np.concatenate(found) if found else np.zeros(0, self.manifest["dtype"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; one task per shard."""
    manifest = read_manifest(folder)
    kind = manifest["dtype"]
    named = [(s["shard"], s["nulls"], s["first_token"]) for s in manifest["shards"]]
    shards = spark.createDataFrame(named, "shard string, nulls bigint, base bigint")
    if len(named) > 1:
        shards = shards.repartition(len(named))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, docs = (_mapped(files, f"{path}/{row['shard']}.{end}", k)
                                      for end, k in (("ids", kind), ("offsets", "<u8"), ("docs", "<i8")))
                for begin in range(0, len(docs), READ):
                    edges = offsets[begin:begin + READ + 1].astype(np.int64)
                    names = np.array(docs[begin:begin + READ])
                    crc = [zlib.crc32(ids[i:j].astype("<u4")) for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, mask=np.arange(begin, begin + len(names)) < row["nulls"]), pa.array(edges[:-1] + row["base"]),
                         pa.array(np.diff(edges)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    """What a new folder of files under the shared checkpoint folder holds, read back."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid.uuid4().hex}"
    write(docs, folder, tokenizer)
    return read(spark, folder)
