"""Suffix-array deduplication: byte strings of 200 that occur more than once.

The suffixes that start at sampled anchors are sorted within each group of equal
anchors, with the length that neighbours have in common: a sparse enhanced suffix
array.  A stack scan over it visits the tree of common-prefix intervals, deepest
first.  The members of an interval share its prefix; sorted by what stands to
their left, a second scan finds those that share enough on that side as well and
differ beyond it.  A set of members is a maximal repeat if its prefix can't be
longer (it is in no single child of the interval) and its left extensions are
diverse; each such group is given with all its members.  Contexts that are equal
throughout are one leaf of the tree with several occurrences.  `repeat_groups`
lists every group with all occurrences; `repeated_bytes` takes their union.

A context reaches 136 bytes to the left and 200 to the right of its anchor, so a
repeat that is longer shows as groups at several anchors that overlap.

A group whose different contexts exceed 4 MB is split in two by where the anchor
stands in the window: for either half the windows share a longer core, which
becomes part of the group's key.  Contexts that are equal within a half are one
leaf from there on.  At the latest when one place is left, all contexts of a group
are equal.  The contexts of a half reach less far, and its groups are maximal as
far as they do.

Edge cases: a null text is empty.  A text under 200 bytes, or one without
repeats, keeps everything.  Bytes may have any value, 0 included.  Repeated rows
are repeats of each other, so all of their bytes go if there are 200.  Rows that
share an id are each cut by what their own text holds.  A row whose id is null is
not compared and keeps everything.  No documents: no rows.  A worker needs about
60 bytes for each byte of its longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchored
from .anchored import context_batches, merged
from .common import apart, materialize, named, parts, sorted_groups, tidied
from .kernels import RangeHasher, U64, mix, text_blocks, window_minima

GRAM = 64
REACH = "key long, cls long, g int, left int, right int"
REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"


def _fold(a: np.ndarray, shift: int, odd: int) -> np.ndarray:
    t = a[:-shift] * U64(odd) + a[shift:]
    t ^= t >> U64(32)
    return t


def _eights(buf: np.ndarray) -> np.ndarray:
    """A mixed value of the eight bytes at every position."""
    n = len(buf) - 7
    words = np.ndarray(n, dtype="<u8", buffer=np.ascontiguousarray(buf), strides=(1,)).astype(U64)
    words += U64(0xA0761D6478BD642F)  # eight zero bytes are no zero
    words *= U64(0x9E3779B97F4A7C15)
    words ^= words >> U64(32)
    words *= U64(0xD6E8FEB86659FD93)
    words ^= words >> U64(32)
    return words


class Bytes:
    """The unit of `anchored` for bytes."""

    def __init__(self, size: int = 200, gram: int = GRAM):
        if gram != GRAM or size <= gram:
            raise ValueError(f"a window must be longer than {GRAM} bytes")
        self.size, self.window = size, size - gram + 1
        self.context_bytes = size + self.window

    def anchors(self, batches):
        for batch in batches:
            for i, _, buf, offs in text_blocks(batch.column(2)):
                if len(buf) < self.size:
                    continue
                eight = _eights(buf)
                gram = _fold(_fold(_fold(eight, 8, 0xC2B2AE3D27D4EB4F), 16, 0x165667B19E3779F9), 32, 0x27D4EB2F165667C5)
                gram *= U64(0x94D049BB133111EB)
                gram ^= gram >> U64(29)
                doc_end = np.repeat(offs[1:], np.diff(offs))
                starts = np.arange(len(buf) - self.size + 1)
                at = window_minima(gram, self.window, starts + self.size <= doc_end[: len(starts)])
                doc = np.searchsorted(offs, at, side="right") - 1
                lo = np.maximum(offs[doc], at - self.window + 1)
                hi = np.minimum(offs[doc + 1], at + self.size)
                context = mix(RangeHasher(eight)(lo, hi - 7) + (at - lo).astype(U64))
                yield anchored.occurrence_rows(batch.column(0), batch.column(1), doc + i, at - offs[doc], gram[at], context, at - lo, hi - at)

    def contexts(self, batches):
        yield from context_batches(batches, str.encode, bytes)

    def halve(self, batches):
        """Each context twice: for the anchors in the first and in the second half of their places in a window."""
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                units, left = r["content"], r["left"]
                right = len(units) - left
                middle = (r["lo"] + r["hi"]) // 2
                for lo, hi in ((r["lo"], middle), (middle, r["hi"])):
                    if lo >= hi or max(lo, self.size - right) > min(left, hi - 1):
                        continue  # no window has its anchor there
                    core = units[left - lo : left - hi + 1 + self.size]
                    start, end = max(0, left - hi + 1), min(len(units), left - lo + self.size)
                    part = units[start:end]
                    rows.append((_hash(r["key"], lo, core), _hash(left - start, part), r["a"], r["c"], left - start, part, lo, hi, end - left))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in HALVES.split(", ")])

    def compare(self, groups: bool):
        """Of each class, how far repeats reach around its anchor; or with groups, a row for each maximal repeat that it is in."""

        def run(table: pa.Table):
            left = np.asarray(table.column("left"), dtype=np.int64)
            found = maximal_repeats(np.asarray(table.column("key")), left, table.column("content").to_pylist(), self.size, self.window)
            if groups:
                rows = [(int(m), g, e, n) for g, (e, n, members) in enumerate(found) for m in members]
                at, number, reach_left, reach_right = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(4))
            else:
                most = np.zeros((2, len(left)), np.int64)
                for e, n, members in found:
                    most[0, members] = np.maximum(most[0, members], e)
                    most[1, members] = np.maximum(most[1, members], n)
                at = np.flatnonzero(most[1])
                number, reach_left, reach_right = np.zeros(len(at), np.int64), most[0, at], most[1, at]
            own = [table.column(c).combine_chunks().take(pa.array(at)) for c in ("key", "cls")]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(x.astype(np.int32)) for x in (number, reach_left, reach_right))], names=["key", "cls", "g", "left", "right"])

        return run


HALVES = "key long, cls long, a long, c long, left int, content binary, lo int, hi int, edge int"


def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(b"\0".join(p if isinstance(p, bytes) else str(p).encode() for p in parts), digest_size=8).digest(), "little", signed=True)


def _padded(rows: list[bytes], width: int) -> np.ndarray:
    """Rows of up to width bytes, with zeros behind."""
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), dtype=np.uint8).reshape(-1, width)


def _sorted(keys: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Order by key, then by row as bytes; what is only a prefix of another comes first, also where zeros follow."""
    whole = np.concatenate([keys.astype(">i8").view(np.uint8).reshape(-1, 8), rows, lengths.astype(">u2").view(np.uint8).reshape(-1, 2)], axis=1)
    return np.argsort(np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").ravel(), kind="stable")


def _common(rows: np.ndarray, lengths: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The length of the common prefix of rows x and rows y."""
    differ = rows[x] != rows[y]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.minimum(first, np.minimum(lengths[x], lengths[y]))


def intervals(lcp: list[int], least: int):
    """(length, first, last) of the common-prefix intervals of a suffix array, inner before outer.

    lcp[i]: what entries i - 1 and i have in common; -1 where they can't be compared.
    """
    stack: list[tuple[int, int]] = []  # (length, first)
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else -1
        first = i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i - 1
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def maximal_repeats(keys: np.ndarray, left: np.ndarray, contents: list[bytes], size: int, window: int):
    """(bytes to the left of the anchor, bytes from it on, members) of each maximal repeat of `size` bytes or more.

    The members are all contexts of one key that hold it.
    """
    n = len(contents)
    if n < 2:
        return
    ahead = [c[a : a + size] for c, a in zip(contents, left.tolist(), strict=True)]
    behind = [c[:a][::-1][: window - 1] for c, a in zip(contents, left.tolist(), strict=True)]
    right_len, left_len = (np.fromiter(map(len, x), np.int64, n) for x in (ahead, behind))
    rights, lefts = _padded(ahead, size), _padded(behind, window - 1)
    order = _sorted(keys, rights, right_len)
    place, rank = np.empty(n, np.int64), np.empty(n, np.int64)
    place[order] = np.arange(n)
    rank[_sorted(keys, lefts, left_len)] = np.arange(n)
    x, y = order[:-1], order[1:]
    lcp = np.full(n, -1, np.int64)
    lcp[1:] = np.where(keys[x] == keys[y], _common(rights, right_len, x, y), -1)
    beside = _common(lefts, left_len, x, y)  # of neighbours in the suffix array, what they share to the left
    for length, first, last in intervals(lcp.tolist(), size - window + 1):
        if last == first + 1:
            if beside[first] + length >= size:
                yield int(beside[first]), length, order[first : last + 1]
            continue
        members = order[first : last + 1]
        members = members[np.argsort(rank[members])]
        shared = _common(lefts, left_len, members[:-1], members[1:])
        if shared.max() + length < size:
            continue
        # Each interval of this scan has diverse left extensions: its members differ beyond `e`.
        for e, a, b in intervals([-1, *shared.tolist()], size - length):
            group = members[a : b + 1]
            at = place[group]
            if lcp[at.min() + 1 : at.max() + 1].min() == length:  # else a child of this interval holds them all, with a longer prefix
                yield e, length, group


def _memberships(docs: DataFrame, found: anchored.Anchors, unit: Bytes, limit: int, groups: bool) -> DataFrame:
    """(a, c, g, left, right): of every class of several occurrences, or that repeats what is in others, the repeats that it is in.

    g tells groups apart; without groups it says nothing, and only the farthest reach counts.
    """
    leaves = found.classes.where("n > 1").select("a", "c", F.xxhash64("a", "c").alias("g"), "left", "right")
    named_ = lambda df: df.select("a", "c", F.xxhash64("key", "g").alias("g"), "left", "right")
    texts = anchored.contexts(docs, found, unit)
    compared = lambda df: sorted_groups(df.select("key", "cls", "left", "content"), ["key"], [], unit.compare(groups), REACH)
    few = F.col("k") <= limit
    if found.shared.where(~few).isEmpty():
        return leaves.unionByName(named_(compared(texts).select("key", "cls", F.col("key").alias("a"), F.col("cls").alias("c"), "g", "left", "right")))
    texts = materialize(texts, "contexts")
    out = [leaves, named_(compared(texts.where(few)).select("key", "cls", F.col("key").alias("a"), F.col("cls").alias("c"), "g", "left", "right"))]
    rows = texts.where(~few).select("key", "a", "c", "left", "content", F.lit(0).alias("lo"), F.lit(unit.window).alias("hi"))
    level = 0
    while True:
        level += 1
        rows = materialize(rows.mapInArrow(tidied(unit.halve), HALVES), f"halves-{level}")
        one = F.min_by(F.struct("a", "c", "left", "content", "lo", "hi", "edge"), F.struct("a", "c")).alias("one")
        classes = materialize(rows.groupBy("key", "cls").agg(F.count("*").alias("n"), one), f"half-classes-{level}")
        sizes = materialize(classes.groupBy("key").agg(F.count("*").alias("k")).where("k > 1"), f"half-groups-{level}")
        equal = materialize(classes.where("n > 1").select("key", "cls"), f"half-leaves-{level}")
        out.append(rows.join(equal, ["key", "cls"]).select("a", "c", F.xxhash64("key", "cls").alias("g"), "left", F.col("edge").alias("right")))
        reach = materialize(compared(classes.join(sizes.where(few), "key").select("key", "cls", "one.left", "one.content")), f"half-reach-{level}")
        out.append(named_(rows.select("key", "cls", "a", "c").join(reach, ["key", "cls"])))
        many = sizes.where(~few)
        if many.isEmpty():
            break
        # The reach of equal contexts is known, so one of them goes on; for groups all do.
        rows = rows.join(many.select(apart("key").alias("key")), "key", "left_semi") if groups else classes.join(many, "key").select("key", "one.*")
        rows = rows.select("key", "a", "c", "left", "content", "lo", "hi")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def _found(docs: DataFrame, size: int, limit: int | None, group_bytes: int, groups: bool) -> tuple[anchored.Anchors, DataFrame]:
    unit = Bytes(size)
    found = anchored.find(docs, unit, across=False)
    return found, _memberships(docs, found, unit, limit or group_bytes // unit.context_bytes, groups)


def repeat_groups(docs: DataFrame, *, size: int = 200, limit: int | None = None, group_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(group, length, doc_id, row, start): every occurrence, in bytes, of each maximal repeat around an anchor.

    row: a hash that tells the texts of one id apart.
    """
    own, _ = named(anchored.texts_of(docs, id_col, text_col))
    found, members = _found(own, size, limit, group_bytes, True)
    each = found.repeated.select("a", "c", "doc_id", "row", "at").join(members.where(F.col("left") + F.col("right") >= size), ["a", "c"])
    return each.select(F.col("g").alias("group"), (F.col("left") + F.col("right")).alias("length"), "doc_id", "row", F.explode("at").alias("at"), "left").withColumn("start", F.col("at") - F.col("left")).drop("at", "left").distinct()


def _cut(batches):
    for whole in batches:
        for batch in parts(whole, 1):
            rows = []
            for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = (text or "").encode()
                runs = merged([(s["start"], s["end"]) for s in spans or ()], len(raw))
                kept, at = hashlib.sha256(), 0
                for a, b in runs:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                rows.append((doc, len(raw), sum(b - a for a, b in runs), len(runs), kept.hexdigest(), [{"start": a, "end": b} for a, b in runs]))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_bytes(docs: DataFrame, *, size: int = 200, limit: int | None = None, group_bytes: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every document.

    limit: contexts of a group that one task compares at once; as many as fit into
    group_bytes if not given.
    """
    own, nameless = named(anchored.texts_of(docs, id_col, text_col))
    found, members = _found(own, size, limit, group_bytes, False)
    # All repeats that a class is in hold its anchor, so their union is one span.
    reach = members.groupBy("a", "c").agg(F.max("left").alias("l"), F.max("right").alias("r")).where(F.col("l") + F.col("r") >= size)
    reached = found.repeated.select("a", "c", "doc_id", "row", "at").join(materialize(reach, "reach"), ["a", "c"])
    spans = F.transform("at", lambda p: F.struct((p - F.col("l")).alias("start"), (p + F.col("r")).alias("end"))).alias("spans")
    cut = anchored.with_spans(own, reached.select("doc_id", "row", spans))
    rest = nameless.select("doc_id", "text", F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"))
    return cut.unionByName(rest).mapInArrow(tidied(_cut), REPORT)
