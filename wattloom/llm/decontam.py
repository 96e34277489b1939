"""Benchmark decontamination by a prefix-filtered join of shingles.

A benchmark item is cut into windows of 13 consecutive words (an item of fewer
words, but not none, is one window).  A window's shingles are ordered by how
often they occur in the whole corpus; as a document must hold all of them, it is
enough to look for the rarest one, the window's prefix.  Documents are joined with
windows on it.  Its place in the window gives the only place where the window could
start, the document's length bounds it, and the words are then compared one by one.

Two passes read the corpus: one counts the shingles that windows have, one emits
those that are a prefix, each with the words around it.  Both leave out what a
filter of fixed size (two bits of 2^filter_bits for each hash) does not hold; it is
all that goes through the driver, and what it lets through by chance meets no window
in the join.  So only shared shingles are shuffled, and a frequent one is split by
the join.

Edge cases: a null or empty text has no words and no hits; an item without words
has no window; a null item id is kept as the empty string in digests.  Windows
that several items share count for each of them.  Repeated items are hit
together and each counts once by its id.  Repeated documents each get their own
row; rows are told apart by a hash of id and text, each is judged by its own text,
and a null id is as good as any other.  Other columns, whatever their names, go
through.  No documents: no rows.  A worker needs about 60 bytes for each byte of
its longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, tidied
from .kernels import ALNUM, RangeHasher, U64, Words, mix, signed, text_blocks

WINDOWS = "words string, size int, shingles array<long>, item string"
FOUND = "row long, doc_id {}, n_words long, s long, at int, since int, around string"


def _words(buf: np.ndarray, offs: np.ndarray) -> Words:
    return Words(buf, offs, ALNUM, lower=True)


def benchmark_windows(benchmark: DataFrame, *, window: int = 13, shingle: int = 3, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct windows: words, size in words, shingle hashes, items."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, buf, offs in text_blocks(batch.column(1)):
                w = _words(buf, offs)
                h = RangeHasher(w.hash)
                rows: list[list] = [[], [], [], []]
                for d in range(j - i):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    size = min(window, b - a)
                    for s in range(a, b - size + 1) if size else ():
                        k = min(shingle, size)
                        at = np.arange(s, s + size - k + 1)
                        rows[0].append(w.text(s, s + size).decode())
                        rows[1].append(size)
                        rows[2].append(signed(_shingle_hash(h(at, at + k), k)).tolist())
                        rows[3].append(ids[i + d].as_py() or "")
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.list_(pa.int64())), pa.array(rows[3], pa.string())], names=["words", "size", "shingles", "item"])

    each = benchmark.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")).mapInArrow(tidied(run), WINDOWS)
    return each.groupBy("words").agg(F.first("size").alias("size"), F.first("shingles").alias("shingles"), F.array_sort(F.collect_set("item")).alias("items"))


def _shingle_hash(h: np.ndarray, k: int) -> np.ndarray:
    return mix(h + U64(k))


def _doc_shingles(w: Words, h: RangeHasher, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions that start a shingle of k words within their document, and the hashes."""
    at = np.arange(len(w.starts))
    at = at[at + k <= w.last()]
    return at, _shingle_hash(h(at, at + k), k)


class Filter:
    """Two bits for each hash, in 2^bits."""

    def __init__(self, shingles: DataFrame, bits: int):
        self.bits = bits
        self.words = np.zeros(max(1, (1 << bits) // 64), dtype=U64)
        place = lambda shift: F.shiftrightunsigned(F.shiftleft("s", shift), 64 - bits)
        both = shingles.select(F.explode(F.array(place(0), place(bits))).alias("p"))
        table = both.groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b")).toArrow()  # at most 2^bits / 64 rows
        self.words[np.asarray(table.column("w"), dtype=np.int64)] = np.asarray(table.column("b"), dtype=np.int64).view(U64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Positions in h that may be known."""
        one = np.arange(len(h))
        for shift in (0, self.bits):
            p = (h[one] << U64(shift)) >> U64(64 - self.bits)
            one = one[(self.words[p >> U64(6)] >> (p & U64(63))) & U64(1) > 0]
        return one


def _count(known, sizes: list[int]):
    def run(batches):
        for batch in batches:
            found = [np.zeros(0, U64)]
            for _, _, buf, offs in text_blocks(batch.column(0)):
                w = _words(buf, offs)
                h = RangeHasher(w.hash)
                for k in sizes:
                    _, s = _doc_shingles(w, h, k)
                    found.append(s[known.value.holds(s)])
            s, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(s)), pa.array(n.astype(np.int64))], names=["s", "n"])

    return run


def _emit(known, sizes: list[int], window: int):
    """A row for each document with its number of words, and one for each prefix in it with the words around."""

    def run(batches):
        names = ["row", "doc_id", "n_words", "s", "at", "since", "around"]
        for batch in batches:
            for i, j, buf, offs in text_blocks(batch.column(2)):
                w = _words(buf, offs)
                h = RangeHasher(w.hash)
                n = j - i
                own = [batch.column(c).slice(i, n) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(w.counts.astype(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names=names)
                for k in sizes:
                    at, s = _doc_shingles(w, h, k)
                    hit = known.value.holds(s)
                    at, s = at[hit], s[hit]
                    doc = np.searchsorted(w.first, at, side="right") - 1
                    since, to = np.maximum(w.first[doc], at - window + 1), np.minimum(w.first[doc + 1], at + window)
                    around = [w.text(a, b).decode() for a, b in zip(since.tolist(), to.tolist(), strict=True)]
                    which = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([own[0].take(which), own[1].take(which), pa.nulls(len(at), pa.int64()), pa.array(signed(s)), *(pa.array((x - w.first[doc]).astype(np.int32)) for x in (at, since)), pa.array(around, pa.string())], names=names)

    return run


def _covered(spans: Column) -> Column:
    """How many places a list of (start, end) covers."""
    begin = F.struct(F.lit(0).alias("e"), F.lit(0).cast("long").alias("t"))
    step = lambda a, s: F.struct(F.greatest(a["e"], s["end"]).alias("e"), (a["t"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["e"]))).alias("t"))
    return F.aggregate(F.array_sort(spans), begin, step, lambda a: a["t"])


def _report(texts: DataFrame, benchmark: DataFrame, window: int, shingle: int, item_col: str, item_text_col: str, share: int, filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """texts (row, doc_id, text): a row for each with n_words, and for those with a hit row, spans, items."""
    spark = texts.sparkSession
    windows = materialize(benchmark_windows(benchmark, window=window, shingle=shingle, id_col=item_col, text_col=item_text_col), "benchmark-windows")
    sizes = sorted(r["k"] for r in windows.select(F.least(F.lit(shingle), "size").alias("k")).distinct().collect())  # at most `shingle` rows
    each = windows.select("words", "size", "items", F.posexplode("shingles").alias("place", "s"))
    known = spark.sparkContext.broadcast(Filter(each.select("s"), filter_bits))
    counts = texts.select("text").mapInArrow(tidied(_count(known, sizes)), "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    # A window with a shingle that no document has is in none.
    ordered = each.select("words", "size", "place", "s").join(counts, "s", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ordered.groupBy("words").agg(F.min(F.struct("n", "place", "s")).alias("r")).where("r.n > 0").select("words", "r.place", "r.s")
    prefixes = materialize(rarest.join(windows.select("words", "size", "items"), "words"), "prefixes")
    sent = spark.sparkContext.broadcast(Filter(prefixes.select("s"), filter_bits))
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = materialize(texts.mapInArrow(tidied(_emit(sent, sizes, window)), FOUND.format(kind)), "prefix-places")
    start = F.col("at") - F.col("place")
    met = found.where("s is not null").select("row", "s", "at", "since", "around").join(prefixes, "s").where(start >= 0)
    same = F.array_join(F.slice(F.split("around", " "), start - F.col("since") + 1, F.col("size")), " ") == F.col("words")
    spans = met.where(same).select("row", "items", F.struct(start.alias("start"), (start + F.col("size")).alias("end")).alias("span"))
    hits = spans.groupBy("row").agg(F.collect_set("span").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    hits = hits.select("row", _covered(F.col("spans")).alias("n_hit"), "items")
    return found.where("s is null").select("row", "doc_id", "n_words"), hits


def _contaminated(share: int) -> Column:
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(F.xxhash64(doc_id, text).alias("row"), doc_id.alias("doc_id"), text.alias("text"))


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: int = 20, filter_bits: int = 24) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated when it has a hit word and share * n_hit >= n_words.
    """
    each, hits = _report(_rows(docs, id_col, text_col), benchmark, window, shingle, item_col, item_text_col, share, filter_bits)
    found = each.join(materialize(hits, "hits"), "row", "left").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", F.array().cast("array<string>"))})
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), _contaminated(share).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: int = 20, filter_bits: int = 24) -> DataFrame:
    """The documents that are not contaminated, with their own columns; each row goes or stays by its own text."""
    texts = _rows(docs, id_col, text_col)
    each, hits = _report(texts, benchmark, window, shingle, item_col, item_text_col, share, filter_bits)
    (key,) = fresh(docs, "__row")
    bad = materialize(each.join(materialize(hits, "hits"), "row").where(_contaminated(share)).select(F.col("row").alias(key)).distinct(), "contaminated")
    marked = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    return marked.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
