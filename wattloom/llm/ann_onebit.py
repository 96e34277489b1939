"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is normalised, padded with zeros to eight times its dimensions and rotated by one
random orthogonal matrix; its code is the signs of the result, packed into bits.
The code's own inner product with the vector, c, is its correction scalar.  A
query is rotated likewise and rounded to 4 bits a component, kept as bit planes.
The inner product of code and query is then a weighted sum of counts of common
bits; divided by c it estimates the cosine without bias, with an error of
sqrt((1 - c^2) / c^2 / (bits - 1)) and a share for the rounding.  `width` of these
standard errors make the bounds.

1. Equal vectors are one class, with the k + 1 smallest of its rows: no other row
   of it can be among a query's k nearest.
2. Classes are dealt to chunks and queries to blocks, both of bounded size, and
   every block meets every chunk in a group of its own.  A task streams a group's
   codes past its queries and keeps each query's k + 1 best lower bounds; over all
   chunks the (k + 1)-th best is the query's bar.
3. A second pass over the codes gives what reaches the bar with its upper bound:
   a few hundredths, fewer the more vectors there are.  These are scored on the
   original vectors in double precision.

Nothing passes through the driver but three counts.

A cosine needs two vectors of one length, so vectors are searched among those of
their own (`nearest`): an index and a search for each length that occurs.

Edge cases: a vector that is null, has another length than the index, holds a null
or a component that is not finite, or is all zero takes no part, neither as a
query nor as a candidate.  Scores that agree to 12 decimals are equal and go to
the smaller id.  A query's own row is no candidate; other rows with its id are,
and rows that repeat a query's id are queries of their own.  A null id takes no
part.  Fewer than k candidates: all of them.  No vectors: no rows.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, tidied

INDEX = "vec_id long, vector binary, code binary, correction double"
LOWS = "query long, low double"
CANDIDATES = "query long, cand long"
_PLANES = 4
_PARTS = 2048  # codes that are compared with as many queries as make a matrix of a million


def code_bits(dims: int) -> int:
    """The length of a code: eight times the vector's, in whole words."""
    return max(64, -(-8 * dims // 64) * 64)


@lru_cache(maxsize=4)
def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that take part, and their vectors."""
    values = column.flatten()  # without the values of null rows
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    ends = np.cumsum(lengths)
    flat = np.asarray(values.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)  # a null is a NaN
    rows = np.flatnonzero(lengths == dims)
    m = flat[(ends[rows] - dims)[:, None] + np.arange(dims)] if len(rows) else np.zeros((0, dims))
    with np.errstate(all="ignore"):
        ok = np.isfinite(m).all(axis=1) & (np.abs(m).max(axis=1, initial=0) > 0)
    return rows[ok], m[ok]


def _unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.abs(m).max(axis=1, keepdims=True, initial=0)
    m = m / np.where(top > 0, top, 1)  # so that squares neither overflow nor vanish
    norm = np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
    return m / np.where(norm > 0, norm, 1), (top * norm)[:, 0]


def encode(m: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, norms, and corrections of the rows of m; turn: bits x dims, with orthonormal columns."""
    unit, norm = _unit(m)
    turned = unit @ turn.T
    return np.packbits(turned >= 0, axis=1), norm, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])


class Queries:
    """Rotated queries as bit planes."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray):
        self.bits = turn.shape[0]
        t = _unit(vectors)[0] @ turn.T
        self.low = t.min(axis=1, initial=0)
        self.step = np.maximum(t.max(axis=1, initial=0) - self.low, 1e-12) / ((1 << _PLANES) - 1)
        u = np.rint((t - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.total = self.low * self.bits + self.step * u.sum(axis=1, dtype=np.int64)
        self.planes = np.stack([_words(np.packbits((u >> j) & 1, axis=1)) for j in range(_PLANES)])

    def estimate(self, part: slice, codes: np.ndarray, correction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of some queries and all codes: the estimated cosine, and its standard error."""
        common = np.zeros((len(self.low[part]), len(codes)), dtype=np.uint16)
        for j in range(_PLANES):
            for w in range(codes.shape[1]):
                common += np.bitwise_count(self.planes[j, part, w, None] & codes[None, :, w]).astype(np.uint16) << np.uint16(j)
        ones = np.bitwise_count(codes).sum(axis=1)
        c = np.maximum(correction, 1e-9)
        low, step, total = (x[part, None] for x in (self.low, self.step, self.total))
        value = (2 * (low * ones[None] + step * common) - total) / np.sqrt(self.bits) / c
        error = np.sqrt((np.maximum(0, 1 - c**2) / max(1, self.bits - 1)) + step**2 / 3) / c
        return value, error


def _words(packed: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(packed).view(np.uint64)


def build_index(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int, seed: int = 7) -> DataFrame:
    """One row for each vector that takes part, written: row (its own number), vec_id, vector, code, correction, cls (equal vectors have the same)."""

    def run(batches):
        for batch in batches:
            rows, m = _matrix(batch.column(1), dims)
            if not len(rows):
                continue
            code, _, correction = encode(m, rotation(code_bits(dims), seed)[:, :dims])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)).cast(pa.int64()), pa.array([x.tobytes() for x in m], pa.binary()), pa.array([x.tobytes() for x in code], pa.binary()), pa.array(correction)], names=["vec_id", "vector", "code", "correction"])

    some = vectors.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`"), F.col(f"`{vector_col}`"))
    made = some.mapInArrow(tidied(run), INDEX)
    return materialize(made.select(F.monotonically_increasing_id().alias("row"), "*", F.sha2("vector", 256).alias("cls")), "onebit-index")


def _meet(dims: int, seed: int, k: int, width: float, bars: bool):
    """Groups of (block, chunk), queries first: each query's k best lower bounds (bars), or what reaches its bar."""

    def run(batches):
        now, waiting, held = None, [], None

        def known():
            vectors = np.frombuffer(b"".join(w[1] for w in waiting), dtype=np.float64).reshape(-1, dims)
            ids, bar = (np.array([w[c] for w in waiting], dtype=t) for c, t in ((0, np.int64), (2, np.float64)))
            return Queries(vectors, rotation(code_bits(dims), seed)[:, :dims]), ids, bar, np.full((len(waiting), k), -9.0)

        def lows():
            if held and bars:
                _, ids, _, best = held
                some = best > -9
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, some.sum(axis=1))), pa.array(best[some])], names=["query", "low"])

        for whole in batches:
            group = np.asarray(whole.column(0), dtype=np.int64) << 32 | np.asarray(whole.column(1), dtype=np.int64)
            asks = np.asarray(whole.column(2))
            cuts = np.flatnonzero((group[1:] != group[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows], strict=True):
                if group[a] != now:
                    yield from lows()
                    now, waiting, held = group[a], [], None
                part = whole.slice(a, b - a)
                if asks[a]:
                    waiting += zip(*(part.column(c).to_pylist() for c in (3, 4, 5)), strict=True)
                    continue
                if not waiting:
                    continue
                held = held or known()
                for s in range(0, part.num_rows, _PARTS):
                    some = part.slice(s, _PARTS)
                    rows = np.asarray(some.column(3))
                    codes = np.frombuffer(b"".join(some.column(6).to_pylist()), dtype=np.uint64).reshape(len(rows), -1)
                    yield from _compare(*held, rows, codes, np.asarray(some.column(7)), width, bars)
        yield from lows()

    return run


def _compare(queries: Queries, ids: np.ndarray, bar: np.ndarray, best: np.ndarray, rows: np.ndarray, codes: np.ndarray, correction: np.ndarray, width: float, bars: bool):
    """Bring best, the highest lower bounds of each query so far, up to date; or yield what reaches the bar."""
    k = best.shape[1]
    for q in range(0, len(ids), 512):
        part = slice(q, q + 512)
        value, error = queries.estimate(part, codes, correction)
        if bars:
            best[part] = np.partition(np.concatenate([best[part], value - width * error], axis=1), -k, axis=1)[:, -k:]
        else:
            qi, ci = np.nonzero(value + width * error >= bar[part, None])
            yield pa.RecordBatch.from_arrays([pa.array(ids[part][qi]), pa.array(rows[ci])], names=["query", "cand"])


def _score(dims: int):
    def run(batches):
        for batch in batches:
            q, v = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.float64).reshape(-1, dims) for c in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.einsum("ij,ij->i", _unit(q)[0], _unit(v)[0]))], names=["query", "cand", "score"])

    return run


def candidates(index: DataFrame, queries: DataFrame, *, k: int = 5, dims: int, seed: int = 7, width: float = 2.5, chunk: int = 65_536, query_block: int = 2048) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(query, cand) to be scored, both as the first row of a class; the classes (cls, row, vector); and each class' k + 1 smallest rows (cls, vec_id, row)."""
    spark = index.sparkSession
    smallest = Window.partitionBy("cls").orderBy("vec_id", "row")
    members = materialize(index.select("cls", "vec_id", "row").withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1), "members")
    classes = materialize(index.join(members.where("place = 1").select("row"), "row").select("row", "cls", "vector", "code", "correction"), "classes")
    asked = materialize(queries.select("cls").distinct().join(classes, "cls").select("row", "vector"), "queries")
    n, n_asked = classes.count(), asked.count()
    # At least as many chunks as there are tasks at a time, if they hold enough codes.
    chunks = max(1, -(-n // chunk), min(spark.sparkContext.defaultParallelism, n // _PARTS))
    blocks = max(1, -(-n_asked // query_block))
    dealt = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)

    def met(ask: DataFrame) -> DataFrame:
        left = ask.select(dealt(blocks).alias("block"), every(chunks).alias("chunk"), F.lit(True).alias("asks"), "row", "vector", "bar", null("binary", "code"), null("double", "correction"))
        right = classes.select(every(blocks).alias("block"), dealt(chunks).alias("chunk"), F.lit(False).alias("asks"), "row", null("binary", "vector"), null("double", "bar"), "code", "correction")
        return left.unionByName(right).repartition("block", "chunk").sortWithinPartitions("block", "chunk", F.desc("asks"))

    lows = met(asked.withColumn("bar", F.lit(-9.0))).mapInArrow(tidied(_meet(dims, seed, k + 1, width, True)), LOWS)
    best = lows.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("low")))).where(F.col("place") <= k + 1)
    bars = best.groupBy(F.col("query").alias("row")).agg(F.when(F.count("*") > k, F.min("low")).otherwise(F.lit(-9.0)).alias("bar"))
    known = materialize(asked.join(bars, "row"), "bars")
    return met(known).mapInArrow(tidied(_meet(dims, seed, k + 1, width, False)), CANDIDATES), classes, members


def search(index: DataFrame, queries: DataFrame, *, k: int = 5, dims: int, seed: int = 7, width: float = 2.5, chunk: int = 65_536, query_block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest by cosine.

    queries: rows of the index.  width: the bounds in standard errors; the larger,
    the more vectors are scored exactly.  chunk, query_block: so many codes and
    queries at most meet in one group.
    """
    few, classes, members = candidates(index, queries, k=k, dims=dims, seed=seed, width=width, chunk=chunk, query_block=query_block)
    vectors = classes.select("row", "vector")
    pairs = few.join(vectors.withColumnsRenamed({"row": "query", "vector": "q"}), "query").join(vectors.withColumnsRenamed({"row": "cand", "vector": "v"}), "cand")
    scored = pairs.select("query", "cand", "q", "v").mapInArrow(tidied(_score(dims)), "query long, cand long, score double")
    nearest = Window.partitionBy("query").orderBy(F.desc(F.round("score", 12)), "vec_id", "row")
    # The first row of a class has its smallest id, so k + 1 classes hold the k + 1 nearest rows.
    named = scored.join(members.where("place = 1").select(F.col("row").alias("cand"), "cls", "vec_id"), "cand").withColumn("row", F.col("cand"))
    top = materialize(named.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1).select("query", "cls", "score"), "nearest-classes")
    rows = top.join(members.drop("place"), "cls").withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1).drop("place", "cls")
    asked = queries.select("cls", F.col("vec_id").alias("query_id"), F.col("row").alias("own")).join(classes.select("cls", F.col("row").alias("query")), "cls")
    each = asked.join(materialize(rows, "nearest-rows"), "query").where(F.col("row") != F.col("own"))
    last = Window.partitionBy("own").orderBy(F.desc(F.round("score", 12)), "vec_id", "row")
    return each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, asked: Column, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row that `asked` (a condition on vec_id) chooses, among the vectors of its length.

    The driver learns which lengths occur; a table has few.
    """
    length = F.size(F.col(f"`{vector_col}`"))
    lengths = sorted(r["d"] for r in vectors.where(length > 0).select(length.alias("d")).distinct().collect())
    found = []
    for dims in lengths or [1]:
        index = build_index(vectors.where(length == dims) if lengths[1:] else vectors, id_col=id_col, vector_col=vector_col, dims=dims)
        found.append(search(index, index.where(asked), k=k, dims=dims, **options))
    return reduce(DataFrame.unionByName, found)
