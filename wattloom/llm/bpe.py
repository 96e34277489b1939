"""Byte-level BPE encoding and decoding by recursive DuckDB queries in each task.

Encoding: a text is cut by the pattern; each of its matches is a word.  A word that is
itself a token is that token.  All others start as one token for each byte, and a
recursive query contracts them: the positions of every unfinished word's tokens join
the merge table on (token, next token), each word takes its leftmost pair of the least
rank, and so on until no pair of a word has a rank.  The merge table has a row for each
way to cut a token into two tokens.  Words go into the query in runs; a word is looked up
only once for as long as the cache of its Python worker holds it (`tokens.Encoder`: texts
are cut at places where the pattern always cuts, and cached by the pieces between).

Words of more than `LONG` bytes (runs of letters without an end) are contracted with a
heap instead: a step of the recursion costs a word's whole length, so it would be quadratic.

Decoding: ids join the vocabulary's bytes, and an ordered aggregation puts each row's
bytes together; one query for a run of rows.

Nothing is shuffled, and no row depends on another, so a lost executor costs only its
own tasks.  A worker holds the merge table (108,299 rows for a vocabulary of 50,000),
the cache of pieces, and a run of rows.

Edge cases: a null or empty text has no ids and decodes to no bytes.  A null list of
ids decodes to null, an id outside of the vocabulary is an error.  Rows are neither
joined nor told apart, so repeated rows and ids are kept as they are.  Other columns go
through as they are; an output column takes the place of one of its name.  No rows: no
rows.  A text is processed whole; it needs about 60 bytes for each of its own, and a row's
decoding about 50 for each id.
"""

from __future__ import annotations

import base64
import heapq

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, tidied
from .kernels import ragged
from .tokens import Encoder, cut_bytes

LONG = 400
RUN = 20_000  # words a query
RUN_IDS = 1 << 18  # ids a query
PART = 2 << 20  # bytes of text, or of ids, that are turned at once

CONTRACT = """
    WITH RECURSIVE steps(w, ids, best) AS (
      SELECT w, list(id ORDER BY pos), 0::BIGINT FROM bytes GROUP BY w
      UNION ALL
      SELECT w, CASE WHEN found.best IS NULL THEN ids ELSE ids[:(found.best & 1048575) - 1] || [(found.best >> 20)::INT] || ids[(found.best & 1048575) + 2:] END, found.best
      FROM steps JOIN (
        SELECT w, min((rank << 20) | pos) AS best FROM (
          SELECT w, unnest(range(1, len(ids) + 1)) AS pos, (unnest(ids)::BIGINT << 20) | unnest(ids[2:]) AS pair FROM steps WHERE best IS NOT NULL
        ) LEFT JOIN merges USING (pair) GROUP BY w
      ) AS found USING (w)
    )
    SELECT ids FROM steps WHERE best IS NULL ORDER BY w
"""
DECODE = """
    SELECT unhex(array_to_string(list(hex ORDER BY pos), '')) AS bytes FROM ids JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file: base64, space, number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """pair (left id and right id in 20 bits each) and rank of each way to make a token from two."""
    pairs, made = [], []
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                pairs.append(left << 20 | right)
                made.append(rank)
    return pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(made, pa.int64())})


def _connection() -> duckdb.DuckDBPyConnection:
    """A database in memory: one thread, as Spark runs a task on each core; nothing goes to the machine's disk."""
    return duckdb.connect(config={"threads": 1, "memory_limit": "700MB", "temp_directory": "", "preserve_insertion_order": False})


class RankEncoder(Encoder):
    """ids by a table of ranks and a pattern; one for each process, rank file and pattern."""

    slots, pool_size = 1 << 21, 1 << 23
    cut = staticmethod(cut_bytes)
    specials: list[bytes] = []
    _made: dict[tuple[str, str], RankEncoder] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> RankEncoder:  # type: ignore[override]
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def __init__(self, path: str, pattern: str):
        self.words = regex.compile(pattern).findall
        self.ranks = read_ranks(path)
        if max(self.ranks.values()) >= 1 << 20:
            raise ValueError("ids of 20 bits at most")
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.con = _connection()
        self.con.register("given", merge_table(self.ranks))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.con.unregister("given")
        self._clear()

    def _heaped(self, word: bytes) -> list[int]:
        """The same contraction of one long word, with its pairs in a heap."""
        ids, n = self.byte_id[np.frombuffer(word, np.uint8)].tolist(), len(word)
        ends = list(range(1, n + 1))  # where the token from each place ends; 0: no token begins here any more
        before = list(range(-1, n - 1))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := self.ranks.get(word[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k, end = heapq.heappop(heap)
            middle = ends[k]
            if not middle or middle >= n or ends[middle] != end:
                continue  # one of the two has changed
            ids[k], ends[k], ends[middle] = rank, end, 0
            if end < n:
                before[end] = k
                if (r := self.ranks.get(word[k : ends[end]])) is not None:
                    heapq.heappush(heap, (r, k, ends[end]))
            if before[k] >= 0 and (r := self.ranks.get(word[before[k] : end])) is not None:
                heapq.heappush(heap, (r, before[k], end))
        out, k = [], 0
        while k < n:
            out.append(ids[k])
            k = ends[k]
        return out

    def contracted(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty words, flat, and the number of each."""
        flat, lengths = [np.zeros(0, np.int32)], []
        for i in range(0, len(words), RUN):
            run = words[i : i + RUN]
            sizes = np.fromiter(map(len, run), np.int64, len(run))
            buf = np.frombuffer(b"".join(run), np.uint8)
            places = np.arange(len(buf)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            self.con.register("bytes", pa.table({"w": np.repeat(np.arange(len(run), dtype=np.int32), sizes), "pos": places, "id": self.byte_id[buf]}))
            found = self.con.sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
            self.con.unregister("bytes")
            flat.append(found.flatten().to_numpy())
            lengths.append(found.value_lengths().to_numpy())
        return np.concatenate(flat), np.concatenate([np.zeros(0, np.int32), *lengths]).astype(np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each text, flat, and the number of each."""
        numbers: dict[str, int] = {}
        each = [[numbers.setdefault(w, len(numbers)) for w in self.words(t)] for t in texts]
        own: list[list[int] | None] = []
        rest = []
        for w in (w.encode() for w in numbers):
            known = self.ranks.get(w)
            own.append([known] if known is not None else self._heaped(w) if len(w) > LONG else None)
            if own[-1] is None:
                rest.append(w)
        flat, lengths = self.contracted(rest)
        at = iter(zip((np.cumsum(lengths) - lengths).tolist(), lengths.tolist(), strict=True))
        extra: list[int] = []
        begin, length = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for k, ids in enumerate(own):
            if ids is None:
                begin[k], length[k] = next(at)
            else:
                begin[k], length[k] = len(flat) + len(extra), len(ids)
                extra += ids
        pool = np.concatenate([flat, np.array(extra, np.int32)]).astype(np.uint32)
        used = np.fromiter((k for e in each for k in e), np.int64)
        per_text = np.repeat(np.arange(len(texts)), [len(e) for e in each])
        return pool[ragged(begin[used], length[used])], np.bincount(per_text, weights=length[used], minlength=len(texts)).astype(np.int64)

    def _encode_joined(self, pieces: list[bytes]) -> None:
        """Pieces need no joining: a query takes as many as there are."""


class Decoder:
    """Bytes of ids; one for each process and rank file."""

    _made: dict[str, Decoder] = {}

    @classmethod
    def of(cls, path: str) -> Decoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.known = np.zeros(max(ranks.values()) + 2, dtype=bool)
        self.known[list(ranks.values())] = True
        self.con = _connection()
        self.con.register("given", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": [b.hex() for b in ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.con.unregister("given")

    def column(self, ids: pa.ListArray | pa.BinaryArray) -> pa.Array:
        """The bytes of each list, or of each binary that holds ids in 32 bits."""
        if pa.types.is_binary(ids.type):
            lengths = pc.fill_null(pc.binary_length(ids), 0).to_numpy().astype(np.int64) // 4
            flat = np.frombuffer(b"".join(x for x in ids.to_pylist() if x), "<u4").astype(np.int32)
        else:
            lengths = ids.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
        top = len(self.known) - 1
        if len(flat) and not self.known[np.clip(flat, -1, top)].all():
            raise ValueError("ids that are not in the vocabulary")
        ends = np.cumsum(lengths)
        out: list[bytes] = [b""] * len(ids)
        i = 0
        while i < len(ids):
            start = int(ends[i] - lengths[i])
            j = max(i + 1, int(np.searchsorted(ends, start + RUN_IDS, side="right")))
            doc = np.repeat(np.arange(i, j), lengths[i:j])
            if len(doc):
                self.con.register("ids", pa.table({"doc": doc, "pos": np.arange(len(doc)), "id": flat[start : start + len(doc)]}))
                found = self.con.sql(DECODE).to_arrow_table().column("bytes").to_pylist()
                self.con.unregister("ids")
                for k, b in zip(np.unique(doc).tolist(), found, strict=True):
                    out[k] = b
            i = j
        return pa.array([None if null else b for null, b in zip(ids.is_null().to_pylist(), out, strict=True)], pa.binary())


def _turned(df: DataFrame, column: str, out: str, kind: str, fn, dropped: bool) -> DataFrame:
    """df with a further column of that type, made of a column's parts of bounded size; dropped: without the column itself."""
    names = [c for c in df.columns if c.lower() != out.lower()]
    at = names.index(column)
    kept = [k for k in range(len(names)) if not (dropped and k == at)]
    fields = [f"`{names[k].replace('`', '``')}` {df.schema[names[k]].dataType.simpleString()}" for k in kept]
    plain = df.select(*(F.col("`" + n.replace("`", "``") + "`").alias(f"c{k}") for k, n in enumerate(names)))  # mapInArrow takes no names with dots

    def run(batches):
        for whole in batches:
            for batch in parts(whole, at, PART):
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), fn(batch.column(at))], names=[*(f"c{k}" for k in kept), "out"])

    return plain.mapInArrow(tidied(run), ", ".join([*fields, f"`{out}` {kind}"]))


def encode(docs: DataFrame, *, ranks: str, pattern: str, text_col: str = "text", ids_col: str = "ids", as_bytes: bool = False, drop_text: bool = False) -> DataFrame:
    """docs with the ids of each whole text: an array, or little-endian unsigned integers of 32 bits back to back."""

    def ids(texts: pa.Array) -> pa.Array:
        blocks = [(flat, counts) for _, _, flat, counts in RankEncoder.of(ranks, pattern).column(texts)]
        flat = np.concatenate([np.zeros(0, np.uint32), *(f for f, _ in blocks)])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(c for _, c in blocks)]))])
        if as_bytes:
            return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(flat.astype("<u4"))])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))

    return _turned(docs, text_col, ids_col, "binary" if as_bytes else "array<int>", ids, drop_text)


def decode(rows: DataFrame, *, ranks: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """rows with the bytes that their ids stand for; ids as encode gives them, in either form."""
    return _turned(rows, ids_col, bytes_col, "binary", lambda ids: Decoder.of(ranks).column(ids), False)
