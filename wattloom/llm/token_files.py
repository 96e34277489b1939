"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned and sorted by id; each task encodes its texts and
writes shards of bounded size: `.bin`, the ids back to back in the narrowest
unsigned type that the vocabulary fits, `.idx`, one 64-bit offset for each document
and one more for the end, and `.ids`, the document ids.  A shard ends with the
document that reaches `shard_tokens` ids or `shard_docs` documents.  The offsets
count from the shard's own start; a shard's base, the number of ids before it,
comes from prefix sums over the shards' totals and stands in the manifest, a small
table of one row for each shard.  A shard is written under a name of its own
attempt and renamed when it is complete, so a task that is lost or run twice does
no harm.  Readers map the files to memory where the file system is local, and read
ranges of them otherwise; they never hold more than a run of documents.

Edge cases: a null or empty text is a document of the end id alone.  Rows that
repeat an id follow one another, ordered by a hash of their texts.  A null id
sorts first and is stored as -2^63, which is therefore no usable id.  No
documents: no shard.  A worker needs about 60 bytes for each byte of its longest
text.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidied
from .tokens import Encoder

NO_ID = -(1 << 63)
MANIFEST = "part int, number int, path string, n_docs long, n_tokens long, width int"


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


class _Shard:
    """A shard that is being written, under a name of its own attempt."""

    def __init__(self, store: fs.FileSystem, root: str, name: str, kind: type):
        self.store, self.root, self.name, self.kind = store, root, name, kind
        self.trial = f"{root}/.{name}-{uuid.uuid4().hex}"
        self.out = store.open_output_stream(f"{self.trial}.bin")
        self.ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.docs = self.tokens = 0

    def add(self, ids: np.ndarray, counts: np.ndarray, tokens: np.ndarray) -> None:
        self.out.write(tokens.astype(self.kind).tobytes())
        self.ids.append(ids)
        self.counts.append(counts)
        self.docs += len(ids)
        self.tokens += len(tokens)

    def close(self, folder: str, part: int, number: int) -> pa.RecordBatch:
        self.out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(self.counts))]).astype(np.uint64)
        for name, data in (("idx", offsets), ("ids", np.concatenate(self.ids).astype(np.int64))):
            with self.store.open_output_stream(f"{self.trial}.{name}") as f:
                f.write(data.tobytes())
        for name in ("bin", "idx", "ids"):
            self.store.move(f"{self.trial}.{name}", f"{self.root}/{self.name}.{name}")
        columns = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([f"{folder}/{self.name}"]), pa.array([self.docs], pa.int64()), pa.array([self.tokens], pa.int64()), pa.array([np.dtype(self.kind).itemsize], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["part", "number", "path", "n_docs", "n_tokens", "width"])


def write_token_files(docs: DataFrame, folder: str, *, tokenizer: str, end_id: int, shard_tokens: int = 1 << 26, shard_docs: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards into folder (shared by all executors) and return the manifest.

    The manifest: part and number (the order of the shards), path, n_docs, n_tokens,
    width (bytes of an id), base.
    """
    spark = docs.sparkSession
    at = _opened(folder)
    at[0].create_dir(at[1], recursive=True)

    def run(batches):
        encoder = Encoder.of(tokenizer)
        kind = np.uint16 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32
        store, root = _opened(folder)
        part, number, shard = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(NO_ID))
            for i, _, flat, n in encoder.column(batch.column(1)):
                ends = np.cumsum(n + 1)
                whole = np.full(len(flat) + len(n), end_id, dtype=np.uint32)
                body = np.ones(len(whole), dtype=bool)
                body[ends - 1] = False
                whole[body] = flat
                a = 0
                while a < len(n):
                    shard = shard or _Shard(store, root, f"shard-{part:06d}-{number:05d}", kind)
                    start = int(ends[a] - n[a] - 1)
                    b = int(np.searchsorted(ends, start + shard_tokens - shard.tokens)) + 1  # with the document that fills it
                    b = min(len(n), max(b, a + 1), a + shard_docs - shard.docs)
                    shard.add(ids[i + a : i + b], n[a:b] + 1, whole[start : int(ends[b - 1])])
                    a = b
                    if shard.tokens >= shard_tokens or shard.docs >= shard_docs:
                        yield shard.close(folder, part, number)
                        number, shard = number + 1, None
        if shard:
            yield shard.close(folder, part, number)

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    shards = sorted(ordered.mapInArrow(tidied(run), MANIFEST).collect())  # a row for each shard
    bases = np.concatenate([[0], np.cumsum([s["n_tokens"] for s in shards])]).astype(int).tolist()
    return spark.createDataFrame([(*s, b) for s, b in zip(shards, bases, strict=False)], MANIFEST + ", base long")


class _Ranges:
    """A file of fixed-width numbers, read by ranges; mapped to memory where it is local."""

    def __init__(self, store: fs.FileSystem, path: str, kind: str):
        self.kind = np.dtype(kind)
        self.file = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)

    def __call__(self, first: int, last: int) -> np.ndarray:
        self.file.seek(first * self.kind.itemsize)
        return np.frombuffer(self.file.read_buffer((last - first) * self.kind.itemsize), dtype=self.kind)


def read_token_files(manifest: DataFrame, *, run_docs: int = 4096, run_tokens: int = 1 << 22) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, as the files have them.

    ids_crc32: of the ids as little-endian unsigned 32-bit integers.  Documents are
    read in runs of at most run_docs, or so many that hold run_tokens.
    """

    def run(batches):
        for batch in batches:
            for s in batch.to_pylist():
                store, path = _opened(s["path"])
                tokens, offsets_of, ids_of = (_Ranges(store, f"{path}.{n}", k) for n, k in (("bin", f"<u{s['width']}"), ("idx", "<u8"), ("ids", "<i8")))
                a = 0
                while a < s["n_docs"]:
                    offsets = offsets_of(a, min(s["n_docs"], a + run_docs) + 1).astype(np.int64)
                    n = max(1, min(len(offsets) - 1, int(np.searchsorted(offsets, offsets[0] + run_tokens, side="right")) - 1))
                    offsets, ids = offsets[: n + 1], ids_of(a, a + n)
                    flat = tokens(int(offsets[0]), int(offsets[-1]))
                    at = offsets - offsets[0]
                    crc = [zlib.crc32(flat[x:y].astype("<u4")) for x, y in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NO_ID), pa.array(offsets[:-1] + s["base"]), pa.array(np.diff(offsets)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    a += n

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(tidied(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
