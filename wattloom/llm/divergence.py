"""How a source's choice of words differs from the other sources of its language.

Terms are runs of letters and of characters outside ASCII (only A-Z lower-cased).  A
language keeps the terms that occur in at least `least` of its documents.

1. Documents of each term are counted: within blocks of texts, then by Spark.
2. Kept terms are sorted over all tasks and cut into shards of `shard_terms`; each
   shard becomes a minimal acyclic transducer (`transducer`), whose ordinals continue
   those of the shards before it, so they follow the terms' bytes.
3. Texts are read again and counted: a block's terms go to the shard in whose range they
   fall, and are streamed through its transducer, which rejects terms that are not kept.
   Counts of a (language, source) are kept by ordinal from here on.
4. Shares p of each count are whole billionths, 1 + floor(1e9 (count + 2) / (N + 2 V)),
   by decimal division; floor((p-q)^2 / (p+q)) measures how two differ.
5. Sources are compared over blocks of terms and blocks of sources, of bounded size,
   with all terms of a block, those that neither source has included; then summed.
   Terms of a source are ranked against the language, ties by ordinal.

What is held at once: a block of texts; one shard; the counts of 64 sources in a
shard.  The driver holds one row for each shard.  A shard that many blocks send
terms to is dealt over several tasks, each with a copy of its transducer.

Terms of a block are told apart by hashes that are confirmed byte by byte.

Edge cases: a null text, language or source is the empty string.  A group without kept
terms takes part with counts of 0; a language without kept terms has `pair` rows of value
0 and no `term` rows.  A language of one source has no `pair` rows.  Repeated rows count
as often as they stand.  Extra columns are ignored, whatever their names.  No documents:
no rows.  A worker needs about 80 bytes for each byte of its longest text.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, tidied
from .kernels import Words, ragged, text_blocks
from .transducer import Transducer

BILLION = 1_000_000_000
TERM_BYTES = np.zeros(256, dtype=bool)
TERM_BYTES[0x61:0x7B] = True  # after lower-casing
TERM_BYTES[0x80:] = True
BLOCK = 2 << 20
TOLD = "lang string, source string, shard int, ordinal long, n long"
_SHARD = "keys binary, target binary, skip binary, final binary"
_SENT = "shard int, salt int, kind int, lang string, sources array<string>, terms binary, lengths array<int>, term array<int>, source array<int>, n array<long>, " + _SHARD


_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # the first k of eight bytes


def _eights(buf: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as one number; zeros beyond the end."""
    return np.ndarray((len(buf),), "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]), strides=(1,))


def _equal(words: Words, other: np.ndarray) -> bool:
    """Are all words the same as their others, which have the same lengths?  Eight bytes at a time."""
    at, length, a, b = _eights(words.buf), words.ends - words.starts, words.starts, words.starts[other]
    while len(a):
        if ((at[a] ^ at[b]) & _LOW[np.minimum(length, 8)]).any():
            return False
        more = length > 8
        length, a, b = length[more] - 8, a[more] + 8, b[more] + 8
    return True


def _kinds(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of its term, and for each term one of its words."""
    h = words.hash
    order = np.argsort(h)
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    kind = np.empty(len(h), dtype=np.int64)
    kind[order] = np.cumsum(new) - 1
    first = order[new]
    length = words.ends - words.starts
    if not (length == length[first][kind]).all() or not _equal(words, first[kind]):  # two terms share a hash
        numbers: dict[bytes, int] = {}
        each = [words.buf[a:b].tobytes() for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]
        kind = np.array([numbers.setdefault(x, len(numbers)) for x in each], dtype=np.int64)
        first = np.unique(kind, return_index=True)[1]
    return kind, first


class _Router:
    """Which shard's range a term falls in, by its first eight bytes; where these are a shard's own, by all of them."""

    def __init__(self, firsts: list[bytes]):
        self.firsts = firsts
        self.heads = np.array([int.from_bytes(f[:8].ljust(8, b"\0"), "big") for f in firsts], dtype=np.uint64)

    def __call__(self, words: Words, which: np.ndarray) -> np.ndarray:
        """For each of these words the place of its shard, or -1."""
        length = words.ends[which] - words.starts[which]
        heads = (_eights(words.buf)[words.starts[which]] & _LOW[np.minimum(length, 8)]).byteswap()
        out = np.searchsorted(self.heads, heads, side="right") - 1
        for k in np.flatnonzero(self.heads[np.maximum(out, 0)] == heads).tolist():
            out[k] = bisect_right(self.firsts, words.buf[words.starts[which[k]] : words.ends[which[k]]].tobytes()) - 1
        return out


def _names(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    found = column.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()


def _blocks(batch: pa.RecordBatch):
    """Words, their documents, terms' numbers and representatives, and the documents' rows, for blocks of a batch's texts."""
    for i, j, buf, offs in text_blocks(batch.column(2), BLOCK):
        words = Words(buf, offs, TERM_BYTES, lower=True)
        if len(words.starts):
            yield i, j, words, np.repeat(np.arange(i, j), words.counts), *_kinds(words)


def _ranges(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words back to back, and their lengths."""
    length = words.ends[which] - words.starts[which]
    return words.buf[ragged(words.starts[which], length)], length


def _document_counts(batches):
    """lang, term, n: in how many documents of a block a term occurs."""
    for batch in batches:
        lang, names = _names(batch.column(0))
        for _, _, words, doc, kind, first in _blocks(batch):
            pairs = np.unique(kind * batch.num_rows + doc)  # a term and a document once
            keys, n = np.unique(pairs // batch.num_rows * len(names) + lang[pairs % batch.num_rows], return_counts=True)
            data, length = _ranges(words, first[keys // len(names)])
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            terms = pa.Array.from_buffers(pa.string(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
            langs = pa.DictionaryArray.from_arrays(pa.array((keys % len(names)).astype(np.int32)), pa.array(names)).dictionary_decode()
            yield pa.RecordBatch.from_arrays([langs, terms, pa.array(n)], names=["lang", "term", "n"])


def _cut(shard_terms: int):
    """part, number and place: sorted terms cut into shards; a shard has one language."""

    def run(batches):
        part, held, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            number, place = [], []
            for lang in batch.column(0).to_pylist():
                if lang != held:
                    held, n = lang, 0
                number.append(n // shard_terms)
                place.append(n % shard_terms)
                n += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(place), pa.int32()), pa.array(number, pa.int32()), pa.array(place, pa.int32())], names=["lang", "term", "part", "number", "place"])

    return run


def _built(batches):
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), *[pa.binary()] * 4]
    names = ["lang", "part", "number", "first", "n_terms", "keys", "target", "skip", "final"]
    for batch in batches:
        for lang, part, number, terms in zip(*(c for c in batch.columns), strict=True):
            terms = terms.as_py()
            row = [lang.as_py(), part.as_py(), number.as_py(), terms[0], len(terms), *Transducer.of(t.encode() for t in terms).stored()]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)


class Vocabulary:
    """terms: lang, term, ordinal.  shards: shard, lang, base and a transducer each."""

    def __init__(self, kept: DataFrame, shard_terms: int):
        spark = kept.sparkSession
        order = [F.col("lang"), F.col("term")]
        told = kept.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        told = materialize(told.mapInArrow(tidied(_cut(shard_terms)), "lang string, term string, part int, number int, place int"), "kept-terms")
        lists = told.groupBy("lang", "part", "number").agg(F.array_sort(F.collect_list("term")).alias("terms"))  # at most shard_terms
        built = materialize(lists.mapInArrow(tidied(_built), "lang string, part int, number int, first string, n_terms long, " + _SHARD), "transducers")
        found = built.select("lang", "part", "number", "first", "n_terms").collect()  # one row for each shard_terms terms
        self.firsts: dict[str, list[bytes]] = {}
        self.numbers: dict[str, list[int]] = {}
        self.sizes: dict[str, int] = {}
        rows = []
        for shard, r in enumerate(sorted(found, key=lambda r: (r["lang"].encode(), r["part"], r["number"]))):
            lang = r["lang"]
            rows.append((lang, r["part"], r["number"], shard, self.sizes.get(lang, 0)))
            self.firsts.setdefault(lang, []).append(r["first"].encode())
            self.numbers.setdefault(lang, []).append(shard)
            self.sizes[lang] = self.sizes.get(lang, 0) + r["n_terms"]
        self.count = len(rows)
        bases = spark.createDataFrame(rows, "lang string, part int, number int, shard int, base long")
        self.bases = bases
        self.shards = built.join(F.broadcast(bases), ["lang", "part", "number"])
        self.terms = told.join(F.broadcast(bases), ["lang", "part", "number"]).select("lang", "term", (F.col("base") + F.col("place")).alias("ordinal"))


def _sender(vocabulary: Vocabulary, salts: int):
    """A block's terms and counts, in a row for each shard that they fall in."""
    routers, numbers = {lang: _Router(firsts) for lang, firsts in vocabulary.firsts.items()}, vocabulary.numbers
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.binary()] * 4]
    names = [c.split()[0] for c in _SENT.split(", ")]

    def run(batches):
        turn = TaskContext.get().partitionId()
        for batch in batches:
            lang, langs = _names(batch.column(0))
            source, sources = _names(batch.column(1))
            for _, _, words, doc, kind, first in _blocks(batch):
                turn += 1
                group = lang[doc] * len(sources) + source[doc]
                groups, group = np.unique(group, return_inverse=True)
                keys, n = np.unique(kind * len(groups) + group, return_counts=True)
                term, group = keys // len(groups), keys % len(groups)
                of_lang = groups // len(sources)
                for number in np.unique(of_lang).tolist():
                    name = langs[number]
                    if name not in routers:
                        continue
                    mine = of_lang[group] == number
                    terms, back = np.unique(term[mine], return_inverse=True)
                    entry = routers[name](words, first[terms])[back]
                    order = np.argsort(entry, kind="stable")
                    order = order[np.searchsorted(entry[order], 0) :]  # terms before the first shard are not kept
                    if not len(order):
                        continue
                    own, counts, terms_of = group[mine][order], n[mine][order], back[order]
                    edges = np.flatnonzero(np.diff(entry[order], prepend=-1, append=len(numbers[name])))
                    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                        used, term_at = np.unique(terms_of[a:b], return_inverse=True)
                        data, length = _ranges(words, first[terms[used]])
                        who, source_at = np.unique(groups[own[a:b]] % len(sources), return_inverse=True)
                        row = [numbers[name][int(entry[order[a]])], turn % salts, 1, name, [sources[s] for s in who.tolist()], data.tobytes(), length.astype(np.int32), term_at.astype(np.int32), source_at.astype(np.int32), counts[a:b], None, None, None, None]
                        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)

    return run


def _counted(batches):
    """Streams what a shard is sent through its transducer; counts by source and ordinal within the shard."""
    transducer: Transducer | None = None
    at: tuple | None = None
    held: dict[str, np.ndarray] = {}

    def told():
        shard, lang = at
        for source, counts in held.items():
            found = np.flatnonzero(counts)
            m = len(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * m, pa.string()), pa.array([source] * m, pa.string()), pa.array([shard] * m, pa.int32()), pa.array(found), pa.array(counts[found])], names=["lang", "source", "shard", "ordinal", "n"])
        held.clear()

    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
            if row["kind"].as_py() == 0:
                if at:
                    yield from told()
                at = (row["shard"].as_py(), row["lang"].as_py())
                transducer = Transducer.loaded(*(row[c].as_py() for c in ("keys", "target", "skip", "final")))
                size = int(row["n"].values[0].as_py())
                continue
            buf = np.frombuffer(row["terms"].as_py(), np.uint8)
            ends = np.cumsum(row["lengths"].values.to_numpy()).astype(np.int64)
            ordinal = transducer.ordinals(buf, ends - row["lengths"].values.to_numpy(), ends)[row["term"].values.to_numpy()]
            order = np.argsort(row["source"].values.to_numpy(), kind="stable")
            order = order[ordinal[order] >= 0]
            ordinal, n, names = ordinal[order], row["n"].values.to_numpy()[order], row["sources"].as_py()
            edges = np.searchsorted(row["source"].values.to_numpy()[order], np.arange(len(names) + 1)).tolist()
            for j, name in enumerate(names):
                if name not in held:
                    if len(held) == 64:
                        yield from told()
                    held[name] = np.zeros(size, dtype=np.int64)
                held[name][ordinal[edges[j] : edges[j + 1]]] += n[edges[j] : edges[j + 1]]  # a term is once in a row for each source
    if at:
        yield from told()


def recounted(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """lang, source, ordinal, n: how often each kept term occurs in each group; only counts above 0.  texts: lang, source, text."""
    spark = texts.sparkSession
    if not vocabulary.count:
        return spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    salts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // vocabulary.count))
    sent = texts.mapInArrow(tidied(_sender(vocabulary, salts)), _SENT)
    none = {"sources": "array<string>", "terms": "binary", "lengths": "array<int>", "term": "array<int>", "source": "array<int>"}
    size = F.array(F.col("n_terms")).alias("n")
    shards = vocabulary.shards.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    shards = shards.select("shard", "salt", F.lit(0).alias("kind"), "lang", *(F.lit(None).cast(t).alias(c) for c, t in none.items()), size, "keys", "target", "skip", "final")
    dealt = shards.unionByName(sent).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    counts = dealt.mapInArrow(tidied(_counted), TOLD).groupBy("lang", "source", "shard", "ordinal").agg(F.sum("n").alias("n"))
    return counts.join(F.broadcast(vocabulary.bases.select("shard", "base")), "shard").select("lang", "source", (F.col("ordinal") + F.col("base")).alias("ordinal"), "n")


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(1e9 (count + 2) / (total + 2 terms)), exactly."""
    return F.expr(f"1 + (cast({BILLION} AS decimal(10, 0)) * cast({count} + 2 AS decimal(20, 0))) div cast({total} + 2 * {terms} AS decimal(21, 0))").cast("long")


def _compared(batches):
    """Sums of floor((p-q)^2 / (p+q)) over a block of terms, for each source of one block with each of another."""

    def dense(firsts: np.ndarray, size: int, entries) -> np.ndarray:
        out = np.repeat(firsts[:, None], size, axis=1)
        if entries is not None:
            fields = entries.flatten()
            out[fields[0].to_numpy(), fields[1].to_numpy()] = fields[2].to_numpy()
        return out

    for batch in batches:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for k in range(batch.num_rows):
            size, a, b = column["size"][k].as_py(), column["a"][k].as_py(), column["b"][k].as_py()
            sides = []
            for x in "ab":
                entries = column["entries_" + x][k]
                sides.append(dense(np.array([s["p0"] for s in column["sources_" + x][k].as_py()], np.int64), size, entries.values if entries.is_valid else None))
            left, right = sides
            rows, columns = len(left), len(right)
            sums = np.empty((rows, columns), dtype=np.int64)
            for i in range(rows):
                d = left[i] - right
                sums[i] = (d * d // (left[i] + right)).sum(axis=1)
            nos = [np.array([s["no"] for s in column["sources_" + x][k].as_py()], np.int64) for x in "ab"]
            one, other, value = np.repeat(nos[0], columns), np.tile(nos[1], rows), sums.ravel()
            keep = one < other if a == b else np.ones(len(one), bool)
            m = int(keep.sum())
            yield pa.RecordBatch.from_arrays([pa.array([column["lang"][k].as_py()] * m, pa.string()), pa.array(one[keep]), pa.array(other[keep]), pa.array(value[keep])], names=["lang", "one", "other", "value"])


def _pairs(counts: DataFrame, groups: DataFrame, *, block: int, chunk: int) -> DataFrame:
    """lang, one, other (numbers of sources, one < other), value, for languages with kept terms.  counts: lang, no, ordinal, p."""
    sources = groups.where("terms > 0").groupBy("lang", "terms", F.floor(F.col("no") / block).alias("block")).agg(F.array_sort(F.collect_list(F.struct("no", F.col("p0")))).alias("sources"))  # at most `block`
    place = F.struct((F.col("no") % block).alias("i"), (F.col("ordinal") % chunk).alias("j"), "p")
    entries = materialize(counts.groupBy("lang", F.floor(F.col("no") / block).alias("block"), F.floor(F.col("ordinal") / chunk).alias("chunk")).agg(F.collect_list(place).alias("entries")), "entries")  # at most block * chunk
    one = sources.select("lang", "terms", F.col("block").alias("a"), F.col("sources").alias("sources_a"))
    other = sources.select("lang", F.col("block").alias("b"), F.col("sources").alias("sources_b"))
    blocks = one.join(other, "lang").where("a <= b")
    blocks = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("terms") - 1) / chunk))))
    size = F.least(F.lit(chunk).cast("long"), F.col("terms") - F.col("chunk") * chunk)
    side = lambda x: entries.select("lang", F.col("block").alias(x), "chunk", F.col("entries").alias("entries_" + x))
    met = blocks.withColumn("size", size).join(side("a"), ["lang", "a", "chunk"], "left").join(side("b"), ["lang", "b", "chunk"], "left")
    met = met.select("lang", "a", "b", "chunk", "size", "sources_a", "sources_b", "entries_a", "entries_b").repartition("lang", "a", "b", "chunk")
    return met.mapInArrow(tidied(_compared), "lang string, one long, other long, value long").groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, *, least: int = 10, top: int = 10, shard_terms: int = 1 << 15, block: int = 64, chunk: int = 2048, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: `pair` rows of each source with the others of its language, and `term` rows of its `top` terms."""
    texts = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    df = texts.mapInArrow(tidied(_document_counts), "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    vocabulary = Vocabulary(df.where(F.col("n") >= least), shard_terms)
    counts = materialize(recounted(texts, vocabulary), "term-counts")

    sizes = vocabulary.terms.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "terms"]).withColumns({"no": F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1, "all_total": F.sum("total").over(Window.partitionBy("lang"))})
    groups = materialize(groups.withColumn("p0", F.when(F.col("terms") > 0, share("0", "total", "terms"))), "groups")

    known = counts.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "terms"))
    sums = _pairs(known.select("lang", "no", "ordinal", "p"), groups, block=block, chunk=chunk)
    both = sums.unionByName(sums.select("lang", F.col("other").alias("one"), F.col("one").alias("other"), "value"))
    mine, others = groups.select("lang", "source", F.col("no").alias("one")), groups.select("lang", F.col("source").alias("item"), F.col("no").alias("other"))
    pairs = mine.join(others, "lang").where("one <> other").join(both, ["lang", "one", "other"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    of_lang = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("all_n"))
    compared = known.join(of_lang, ["lang", "ordinal"]).withColumn("q", share("all_n", "all_total", "terms")).where("p > q")
    valued = compared.withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    ranked = valued.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))).where(F.col("rank") <= top)
    terms = ranked.join(vocabulary.terms, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
