"""Substring deduplication with automata of repeated phrases.

1. Passages of 50 words and more that recur are confirmed among the contexts of a
   shared anchor (see anchored): of each window the owner is a document of a smaller
   id that has it, as a rule the smallest.  A passage is a stretch of its owner's text.
2. The passages of one owner are a shard.  They are cut into phrases of half a
   window, and the shard's phrases are compiled into an Aho-Corasick automaton over
   words.  Whatever repeats over a window holds one whole phrase.
3. Every document that has a repeated anchor is streamed, whole, to the automata of
   the owners that its anchors point to, and to no others.  Each phrase that is met
   is extended both ways, word by word, along its passage; matches of a window or
   more are removed.  So what is removed was compared word by word.  A shard that
   many documents go to is dealt over several tasks, each with the automaton; a
   task holds one automaton and one batch of documents at a time.

Edge cases: a null or empty text has no words.  A text of fewer than 50 words
keeps them all.  Windows that recur only within one document stay.  Rows that
share an id are one document: nothing in them is removed because of one another,
and each is cut by what its own text holds.  A row whose id is null is not
compared and keeps all words.  No documents: no rows.  A worker needs about 60
bytes for each byte of its longest text.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchored
from .anchored import context_batches, merged
from .common import apart, materialize, named, parts, sorted_groups, tidied
from .kernels import RangeHasher, U64, Words, mix, text_blocks, window_minima

GRAM = 10
OWNERS = "a long, c long, owner long, owner_row int, start int, end int"
HALVES = "key long, cls long, a long, c long, doc long, row int, pos int, left int, content binary, lo int, hi int, edge int"
SPANS = "doc_id long, row int, spans array<struct<start:int,end:int>>"
REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,end:int>>"


class WordUnit:
    """The unit of `anchored` for words."""

    def __init__(self, size: int = 50, gram: int = GRAM):
        if not 0 < gram <= size:
            raise ValueError("a gram is from one word to a window")
        self.size, self.gram, self.window = size, gram, size - gram + 1
        self.context_bytes = 8 * (size + self.window)  # words of usual length

    def anchors(self, batches):
        for batch in batches:
            for i, _, buf, offs in text_blocks(batch.column(2)):
                w = Words(buf, offs)
                n = len(w.starts)
                if n < self.size:
                    continue
                h = RangeHasher(w.hash)
                starts = np.arange(n - self.gram + 1)
                gram = h(starts, starts + self.gram)
                last = w.last()
                starts = np.arange(n - self.size + 1)
                at = window_minima(gram, self.window, starts + self.size <= last[: len(starts)])
                doc = np.searchsorted(w.first, at, side="right") - 1
                lo = np.maximum(w.first[doc], at - self.window + 1)
                hi = np.minimum(w.first[doc + 1], at + self.size)
                context = mix(h(lo, hi) + (at - lo).astype(U64))
                yield anchored.occurrence_rows(batch.column(0), batch.column(1), doc + i, at - w.first[doc], gram[at], context, at - lo, hi - at)

    def contexts(self, batches):
        yield from context_batches(batches, lambda text: text.encode().split(), b" ".join)

    def windows(self, contents: list[bytes], seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows of the contexts: the context, the first word in it, and a hash of the words and the context's seed."""
        w = Words(np.frombuffer(b" ".join(contents), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(c) + 1 for c in contents])])[: len(contents) + 1] - np.append(np.zeros(len(contents), np.int64), 1))
        n = np.maximum(0, w.counts - self.size + 1)
        row = np.repeat(np.arange(len(contents)), n)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        begin = at + w.first[row]
        return row, at, mix(RangeHasher(w.hash)(begin, begin + self.size) + seed.astype(np.int64).view(U64)[row])

    def owners(self, table: pa.Table):
        """Of the contexts of each anchor: which windows are also in a document of a smaller id, and where in the smallest one."""
        key, cls, doc, own, pos, left = (np.asarray(table.column(c)) for c in ("key", "cls", "doc", "row", "pos", "left"))
        row, at, h = self.windows(table.column("content").to_pylist(), key)
        order = np.lexsort((row, doc[row], h))  # within equal windows the smallest id first
        row, at, h = row[order], at[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        owner = np.flatnonzero(new)[np.cumsum(new) - 1] if len(h) else np.zeros(0, np.int64)
        known = np.flatnonzero(doc[row[owner]] < doc[row])
        r, o = row[known], row[owner[known]]
        start = pos[o] - left[o] + at[owner[known]]
        order = np.lexsort((start, o, r))
        r, o, start = r[order], o[order], start[order]
        edge = np.ones(len(r), dtype=bool)
        edge[1:] = (r[1:] != r[:-1]) | (o[1:] != o[:-1])
        first = np.flatnonzero(edge)
        last = np.append(first[1:], len(r))[: len(first)] - 1
        # All windows of a context hold its anchor, so those with one owner are one stretch of its text.
        columns = [pa.array(key[r[first]]), pa.array(cls[r[first]]), pa.array(doc[o[first]]), pa.array(own[o[first]]), pa.array(start[first].astype(np.int32)), pa.array((start[last] + self.size).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "c", "owner", "owner_row", "start", "end"])

    def halve(self, batches):
        """Each context twice: for the anchors in the first and in the second half of their places in a window."""
        names = [c.split()[0] for c in HALVES.split(", ")]
        for whole in batches:
            for batch in parts(whole, whole.schema.get_field_index("content"), 1 << 20):
                rows = []
                for r in batch.to_pylist():
                    words, left = r["content"].split(b" "), r["left"]
                    right = len(words) - left
                    middle = (r["lo"] + r["hi"]) // 2
                    for lo, hi in ((r["lo"], middle), (middle, r["hi"])):
                        if lo >= hi or max(lo, self.size - right) > min(left, hi - 1):
                            continue  # no window has its anchor there
                        core = b" ".join(words[left - lo : left - hi + 1 + self.size])
                        start, end = max(0, left - hi + 1), min(len(words), left - lo + self.size)
                        part = b" ".join(words[start:end])
                        rows.append((_hash(r["key"], lo, core), _hash(left - start, part), r["a"], r["c"], r["doc"], r["row"], r["pos"], left - start, part, lo, hi, end - left))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate([pa.int64()] * 5 + [pa.int32()] * 3 + [pa.binary()] + [pa.int32()] * 3)], names=names)


def _hash(*values) -> int:
    return int.from_bytes(hashlib.blake2b(b"\0".join(p if isinstance(p, bytes) else str(p).encode() for p in values), digest_size=8).digest(), "little", signed=True)


def _split(rows: DataFrame, unit: WordUnit, limit: int) -> DataFrame:
    """OWNERS of the classes of anchors with more than `limit` contexts.

    A group is split in two by where the anchor stands in the window: for either half
    the windows share a longer core, which becomes part of the group's key.  Of
    contexts that are equal within a half, all windows are the smallest document's,
    and only that goes on.  At the latest when one place is left, all contexts of a
    group are equal.
    """
    rows = rows.select("key", "a", "c", "doc", "row", "pos", "left", "content", F.lit(0).alias("lo"), F.lit(unit.window).alias("hi"))
    out, level = [], 0
    while True:
        level += 1
        halves = materialize(rows.mapInArrow(tidied(unit.halve), HALVES), f"halves-{level}")
        fields = ["a", "c", "doc", "row", "pos", "left", "content", "lo", "hi", "edge"]
        classes = materialize(halves.groupBy("key", "cls").agg(F.min_by(F.struct(*fields), F.struct("doc", "row", "pos", "a", "c")).alias("one"), F.max("doc").alias("last")), f"half-classes-{level}")
        copied = materialize(classes.where(F.col("last") > F.col("one.doc")).select("key", "cls", F.col("one.doc").alias("owner"), F.col("one.row").alias("owner_row"), (F.col("one.pos") - F.col("one.left")).alias("start"), (F.col("one.pos") + F.col("one.edge")).alias("end")), f"half-copies-{level}")
        out.append(halves.join(copied, ["key", "cls"]).where(F.col("doc") > F.col("owner")).select("a", "c", "owner", "owner_row", "start", "end"))
        sizes = materialize(classes.groupBy("key").agg(F.count("*").alias("k")).where("k > 1"), f"half-groups-{level}")
        few = F.col("k") <= limit
        compared = sorted_groups(classes.join(sizes.where(few), "key").select("key", "cls", "one.doc", "one.row", "one.pos", "one.left", "one.content"), ["key"], [], unit.owners, OWNERS)
        named_ = compared.withColumnsRenamed({"a": "key", "c": "cls"})
        out.append(materialize(named_, f"half-owners-{level}").join(classes.select("key", "cls", "one.a", "one.c"), ["key", "cls"]).select("a", "c", "owner", "owner_row", "start", "end"))
        many = sizes.where(~few)
        if many.isEmpty():
            break
        rows = classes.join(many, "key").select("key", "one.*").drop("edge")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def _owners(docs: DataFrame, found: anchored.Anchors, unit: WordUnit, limit: int) -> DataFrame:
    """(a, c, first, owner, owner_row, start, end): whose text the windows of a class also stand in, and where.

    first: the class' own smallest document.  The windows of other documents of a
    class are owned by `first`, those of the first itself by documents before it.
    """
    copies = found.classes.where(F.col("last") > F.col("first.doc_id"))
    whole = copies.select("a", "c", F.col("first.doc_id").alias("owner"), F.col("first.row").alias("owner_row"), (F.col("first.pos") - F.col("left")).alias("start"), (F.col("first.pos") + F.col("right")).alias("end"))
    texts = anchored.contexts(docs, found, unit)
    columns = ["key", "cls", "doc", "row", "pos", "left", "content"]
    few = F.col("k") <= limit
    if found.shared.where(~few).isEmpty():
        some = sorted_groups(texts.select(*columns), ["key"], [], unit.owners, OWNERS)
    else:
        texts = materialize(texts, "contexts")
        some = sorted_groups(texts.where(few).select(*columns), ["key"], [], unit.owners, OWNERS)
        some = some.unionByName(_split(texts.where(~few), unit, limit))
    firsts = found.classes.select("a", "c", F.col("first.doc_id").alias("first"))
    return materialize(whole.unionByName(some).join(firsts, ["a", "c"]), "owners")


class Shard:
    """The passages of one owner, as an automaton of their phrases."""

    def __init__(self, passages: list[bytes], size: int):
        self.size, self.phrase = size, (size + 1) // 2
        self.words: dict[bytes, int] = {}
        split = [p.split(b" ") for p in passages]
        self.passages = [np.array([self.words.setdefault(w, len(self.words) + 1) for w in p], dtype=np.int64) for p in split]
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for k, p in enumerate(self.passages):
            ids = p.tolist()
            for a in range(0, len(ids) - self.phrase + 1, self.phrase):
                places.setdefault(tuple(ids[a : a + self.phrase]), []).append((k, a))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, where in places.items():
            self.automaton.add_word(words, where)
        self.automaton.make_automaton()
        self.empty = not places

    def locate(self, text: bytes) -> list[tuple[int, int]]:
        """Where the text repeats passages over a window or more: start and end, in words."""
        known = self.words
        ids = [known.get(w, 0) for w in text.split()]
        if self.empty or len(ids) < self.size:
            return []
        found: list[tuple[int, int]] = []
        line = np.array(ids, dtype=np.int64)
        done: dict[tuple[int, int], int] = {}  # diagonal of a passage -> where its last match ends
        for end, where in self.automaton.iter(tuple(ids)):
            begin = end - self.phrase + 1
            for k, a in where:
                if done.get((k, begin - a), 0) > end:
                    continue
                p = self.passages[k]
                n = min(begin, a)
                differ = np.flatnonzero(line[begin - n : begin][::-1] != p[a - n : a][::-1])
                first = begin - (int(differ[0]) if len(differ) else n)
                m = min(len(line) - begin, len(p) - a)
                differ = np.flatnonzero(line[begin : begin + m] != p[a : a + m])
                last = begin + (int(differ[0]) if len(differ) else m)
                done[k, begin - a] = last
                if last - first >= self.size:
                    found.append((first, last))
        return merged(found, len(ids))


def _passages(batches):
    """Of each owner: its passages, words joined by a space."""
    for whole in batches:
        for batch in parts(whole, 2):
            rows = []
            for doc, row, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                rows.append((doc, row, [b" ".join(words[a:b]) for a, b in merged([(s["start"], s["end"]) for s in spans], len(words))]))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.list_(pa.binary())), strict=True)], names=["owner", "owner_row", "passages"])


def _stream(size: int):
    """Rows in order of their shard, its passages first: compile them, then locate them in each text."""

    def run(batches):
        now, shard = None, None
        for whole in batches:
            for batch in parts(whole, whole.schema.get_field_index("text")):
                rows = []
                for r in batch.to_pylist():
                    at = (r["owner"], r["owner_row"], r["salt"])
                    if r["passages"] is not None:
                        now, shard = at, Shard(r["passages"], size)
                    elif now == at:
                        spans = shard.locate(r["text"].encode())
                        if spans:
                            rows.append((r["doc_id"], r["row"], [{"start": a, "end": b} for a, b in spans]))
                columns = list(zip(*rows, strict=True)) or [[]] * 3
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "row", "spans"])

    return run


def spans(docs: DataFrame, unit: WordUnit, *, limit: int | None = None, group_bytes: int = 4 << 20, documents: int = 256) -> DataFrame:
    """(doc_id, row, spans of start and end in words): what repeats windows of documents of smaller ids.  docs: doc_id, row, text; no null id.

    limit: contexts of a group that one task compares at once; as many as fit into
    group_bytes if not given.  documents: about so many go to one copy of a shard.
    """
    found = anchored.find(docs, unit, across=True)
    owners = _owners(docs, found, unit, limit or group_bytes // unit.context_bytes)
    shard = ["owner", "owner_row"]
    later = F.when(F.col("owner") == F.col("first"), F.col("doc_id") > F.col("first")).otherwise(F.col("doc_id") == F.col("first"))
    routes = found.repeated.select("a", "c", "doc_id", "row").join(owners.select("a", "c", "first", *shard), ["a", "c"]).where(later).select("doc_id", "row", *shard).distinct()
    routes = materialize(routes, "routes")
    copies = materialize(routes.groupBy(*shard).agg(F.ceil(F.count("*") / documents).cast("int").alias("salts")), "shards")
    texts = docs.where("text is not null")
    stretches = owners.groupBy(*shard).agg(F.collect_set(F.struct("start", "end")).alias("spans")).withColumnsRenamed({"owner": "doc_id", "owner_row": "row"})
    owned = texts.join(stretches, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"]).select("doc_id", "row", "text", "spans").mapInArrow(tidied(_passages), "owner long, owner_row int, passages array<binary>")
    owned = owned.join(copies, shard).select(*shard, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("row"), F.lit(None).cast("string").alias("text"), "passages")
    sent = routes.join(copies.select(apart("owner").alias("owner"), "owner_row", "salts"), shard).select("doc_id", "row", *shard, F.pmod(F.xxhash64("doc_id", "row"), "salts").cast("int").alias("salt"))
    streamed = texts.join(sent, ["doc_id", "row"]).select(*shard, "salt", "doc_id", "row", "text", F.lit(None).cast("array<binary>").alias("passages"))
    ordered = owned.unionByName(streamed).repartition(*shard, "salt").sortWithinPartitions(*shard, "salt", F.col("passages").isNull())
    return ordered.mapInArrow(tidied(_stream(unit.size)), SPANS)


def _cut(batches):
    for whole in batches:
        for batch in parts(whole, 1):
            rows = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or "").encode().split()
                runs = merged([(s["start"], s["end"]) for s in found or ()], len(words))
                kept, at = [], 0
                for a, b in runs:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": a, "end": b} for a, b in runs]))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])


def repeated_phrases(docs: DataFrame, *, size: int = 50, limit: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed spans (in words) of every document."""
    own, nameless = named(anchored.texts_of(docs, id_col, text_col))
    cut = anchored.with_spans(own, spans(own, WordUnit(size), limit=limit))
    rest = nameless.select("doc_id", "text", F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"))
    return cut.unionByName(rest).mapInArrow(tidied(_cut), REPORT)
