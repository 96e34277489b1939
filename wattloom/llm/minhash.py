"""Near duplicates by b-bit MinHash.

1. Each document becomes the set of its word shingles, as 64-bit hashes, and a
   signature: the minima of 100 hash functions.  Documents with equal sets are one
   class from here on.
2. Candidates: the minima are cut into 25 bands of 4; classes with an equal band
   meet in a bucket.  Buckets of one are dropped first.
3. In a bucket all pairs are estimated from the packed lowest two bits of the
   minima: the share of equal bit pairs, counted by bits and corrected for chance
   agreement.  A pair whose estimate is far under the threshold goes; of the others
   only as many are handed on as connect the bucket's members into families, so a
   bucket hands on fewer rows than it has.  A large bucket is cut into blocks of
   signatures, and each pair of blocks is compared on its own.
4. A family that fits into one task is compared pair by pair on full sets, as a
   matrix product.  In a larger one every member goes once, with its text, to one of
   several tasks, and is compared there with the family's head.  Members that are
   linked with the head need no further comparison with each other.  Of each
   member only the difference from the head's set is kept, and those without a link
   are compared with all members on these differences, which give the size of any
   two members' intersection exactly:
   |x ^ y| = |x ^ head| + |y ^ head| - 2 |(x ^ head) & (y ^ head)|, ^ being the
   symmetric difference.  So texts are moved once, however large a family is.
5. Components: smallest id reachable.

At 85 % a pair has no band in common with a probability of 1e-8, and is under the
estimate's cut with one of 1e-7; at 80 % with 2e-6 and 1e-7.  Everything else is exact.

Rows are told apart by a hash of id and text, so each row of an id is compared by
its own text.  A worker needs about 60 bytes for each byte of its longest text.

Edge cases: a text with fewer words than a shingle has its whole sequence as one
shingle; a null or empty text, or one without words, has no set and is linked
with nothing.  A row whose id is null can't be named, so it is linked with
nothing, its component is null and it is kept.  Repeated rows each get their own
row with the same component; kept is true for each of them if it is for one.
Rows of one id with different texts may be in different components; each is kept
whose component has that id as its smallest.  No documents: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, fresh, materialize, sorted_groups, tidied
from .components import components
from .kernels import NOT_SPACE, RangeHasher, U64, Words, mix, ragged, signed, text_blocks

ROWS, BITS = 4, 2
SIGNED = "row long, doc_id long, n_shingles long, set_a long, set_b long, bits binary, bands array<long>"
STARS = "family long, row long, other long, size long, linked boolean, diff array<long>"


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, flat, and the number of each."""
    w = Words(buf, offs, NOT_SPACE, lower=True)
    counts = w.counts
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = ragged(w.first[:-1], n)
    doc = np.repeat(np.arange(len(counts)), n)
    h = RangeHasher(w.hash)(at, np.minimum(at + k, w.first[1:][doc]))
    edges = np.cumsum(n)
    for a, b in zip((edges - n).tolist(), edges.tolist(), strict=True):
        h[a:b].sort()
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=len(counts))


def _functions(bands: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    size = bands * ROWS
    return rng.integers(1, 1 << 63, size, dtype=np.uint64) | U64(1), rng.integers(0, 1 << 63, size, dtype=np.uint64)


def _minima(h: np.ndarray, counts: np.ndarray, bands: int) -> np.ndarray:
    """One row of minima for each document that has a set."""
    multiply, add = _functions(bands)
    first = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(multiply), len(first)), dtype=np.uint32)
    for f in range(len(multiply)):  # multiply-add, high half: universal on 64-bit values
        out[f] = np.minimum.reduceat(((h * multiply[f] + add[f]) >> U64(32)).astype(np.uint32), first)
    return out.T


def _sign(k: int, bands: int):
    def run(batches):
        for batch in batches:
            for i, j, buf, offs in text_blocks(batch.column(2)):
                h, counts = shingle_sets(buf, offs, k)
                doc = np.flatnonzero(counts)
                some = counts[doc]
                first = np.cumsum(some) - some
                m = _minima(h, counts, bands) if len(doc) else np.zeros((0, bands * ROWS), np.uint32)
                sets = [signed(np.add.reduceat(mix(h + U64(s)), first)) if len(doc) else np.zeros(0, np.int64) for s in (1, 2)]
                two = mix(m.astype(np.uint64)) & U64(3)  # the low bits of a mixed minimum
                bits = np.zeros((len(doc), -(-bands * ROWS // 32) * 8), dtype=np.uint8)
                for c in range(4):
                    part = two[:, c::4].astype(np.uint8)
                    bits[:, : part.shape[1]] |= part << (2 * c)  # what is left over is 0 in all
                key = np.zeros((len(doc), bands), dtype=np.uint64)
                for r in range(ROWS):
                    key = mix(key * U64(31) + m[:, r::ROWS].astype(np.uint64) + np.arange(bands, dtype=np.uint64) * U64(1 << 40))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(doc) + 1) * bands, pa.int32()), pa.array(signed(np.ascontiguousarray(key).ravel())))
                back = pa.array(np.where(counts > 0, np.cumsum(counts > 0) - 1, 0), mask=counts == 0)  # null where there is no set
                columns = [pa.array(sets[0]), pa.array(sets[1]), pa.array([b.tobytes() for b in bits], pa.binary()), lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(counts.astype(np.int64)), *(x.take(back) for x in columns)], names=["row", "doc_id", "n_shingles", "set_a", "set_b", "bits", "bands"])

    return run


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links from the first row of each component of a symmetric matrix to its others.

    With rows in the order of their ids, groups that overlap give the same links.
    """
    n = len(linked)
    seen = np.zeros(n, dtype=bool)
    out = []
    for s in range(n):
        if seen[s]:
            continue
        seen[s] = True
        queue = [s]
        while queue:
            x = queue.pop()
            new = np.flatnonzero(linked[x] & ~seen)
            seen[new] = True
            out += [(s, int(y)) for y in new]
            queue += new.tolist()
    return out


def least_agreement(least: float, functions: int) -> int:
    """Equal pairs of low bits from which on the estimate, corrected for chance, is `least` or more."""
    chance = 1 / (1 << BITS)
    return int(np.ceil(functions * (least * (1 - chance) + chance) - 1e-9))


def _agree(x: np.ndarray, y: np.ndarray, functions: int) -> np.ndarray:
    """How many of the functions' low bits are equal; x and y: packed, as 64-bit words, the last axis a signature's."""
    differ = x ^ y
    differ |= differ >> U64(1)
    differ &= U64(0x5555555555555555)
    return functions - np.bitwise_count(differ).sum(axis=-1, dtype=np.int32)


def likely_pairs(words: np.ndarray, least: int, functions: int) -> np.ndarray:
    """Whether each two signatures agree often enough, a few rows at a time."""
    n = len(words)
    out = np.empty((n, n), dtype=bool)
    for a in range(0, n, 64):
        out[a : a + 64] = _agree(words[a : a + 64, None], words[None], functions) >= least
    return out


def _families(least: float, functions: int):
    """Within each bucket (or pair of blocks of one), links that connect likely pairs."""
    enough = least_agreement(least, functions)

    def run(table: pa.Table):
        key = [np.asarray(table.column(c)) for c in ("bucket", "x", "y")]
        ids = np.asarray(table.column("row"))
        words = np.frombuffer(b"".join(table.column("bits").to_pylist()), dtype=U64).reshape(len(ids), -1)
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        starts = np.concatenate([[0], change])
        ends = np.concatenate([change, [len(ids)]])
        left, right = [], []
        two = starts[ends - starts == 2]  # most buckets: all at once
        two = two[_agree(words[two], words[two + 1], functions) >= enough]
        left.append(ids[two])
        right.append(ids[two + 1])
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a > 2:
                links = _spanning(likely_pairs(words[a:b], enough, functions))
                left.append(ids[[a + x for x, _ in links]] if links else ids[:0])
                right.append(ids[[a + y for _, y in links]] if links else ids[:0])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    return run


def _blocked(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of groups `key` with their size n, dealt to pairs of blocks (x, y) of bounded size.

    A group of up to `size` is one block, alone; else each two blocks are a pair,
    and any two rows of a group meet in one.
    """
    # A power of two, so that blocks of a larger group are parts of those of a smaller one.
    many = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / F.lit(size))))).cast("int")
    block = F.pmod(F.xxhash64("row"), many).cast("int")
    return (
        rows.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), many - 1)))
        .where((F.col("other") != F.col("block")) | (many == 1))
        .withColumn("x", F.least("block", "other"))
        .withColumn("y", F.greatest("block", "other"))
        .drop("block", "other", "n")
    )


def _star(k: int, percent: int):
    """Within each family, or part of one with its head: links with the head, and every set's difference from the head's.

    A family of one part (parts = 1) is compared pair by pair instead: rows with `other`, a link that connects.
    """

    def run(table: pa.Table):
        family, part, row, alone = (np.asarray(table.column(c)) for c in ("family", "part", "row", "parts"))
        change = np.flatnonzero((family[1:] != family[:-1]) | (part[1:] != part[:-1])) + 1
        text = table.column("text").combine_chunks()
        sets: list[np.ndarray] = []
        for _, _, buf, offs in text_blocks(text.chunk(0) if isinstance(text, pa.ChunkedArray) else text):
            h, counts = shingle_sets(buf, offs, k)
            sets += np.split(h, np.cumsum(counts)[:-1])
        out: list[list] = [[] for _ in range(6)]
        for a, b in zip([0, *change.tolist()], [*change.tolist(), len(row)], strict=True):
            if alone[a] == 1:
                links = _spanning(linked_sets(sets[a:b], percent))
                rows = [(family[a], row[a + x], row[a + y], None, None, None) for x, y in links]
            else:
                head = next(sets[i] for i in range(a, b) if row[i] == family[a])
                rows = []
                for i in range(a, b):
                    if row[i] == family[a] and part[i] != 0:
                        continue  # the head's own row is that of the first part
                    diff = np.setxor1d(head, sets[i], assume_unique=True)
                    rows.append((family[a], row[i], None, len(sets[i]), bool(_close(len(head), len(sets[i]), len(diff), percent)), signed(diff)))
            for o, column in zip(out, zip(*rows, strict=True), strict=False):
                o += column
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds, strict=True)], names=["family", "row", "other", "size", "linked", "diff"])

    return run


def _close(a, b, differ, percent: int):
    """Whether 100 * intersection >= percent * union, from two sizes and that of the symmetric difference."""
    return 100 * (a + b - differ) >= percent * (a + b + differ)


def shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """For each of x and each of y, how many values they share; values of one list are distinct."""
    n, m = len(x), len(y)
    both = np.zeros((n, m), dtype=np.float32)
    sizes = np.array([len(s) for s in (*x, *y)], dtype=np.int64)
    if not sizes.sum():
        return both.astype(np.int64)
    _, column = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    row = np.repeat(np.arange(n + m), sizes)
    mine = row < n
    total = int(column.max()) + 1
    shared = (np.bincount(column[mine], minlength=total) > 0) & (np.bincount(column[~mine], minlength=total) > 0)
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(256, (1 << 21) // max(1, n + m))
    for c in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [c, c + width])
        full = np.zeros((n + m, width), dtype=np.float32)
        full[row[a:b], column[a:b] - c] = 1
        both += full[:n] @ full[n:].T  # counts below 2^24 are exact
    return both.astype(np.int64)


def _rest(percent: int):
    """Of each pair of blocks of a family: links of members that have none with the head, from differences."""

    def run(table: pa.Table):
        key = [np.asarray(table.column(c)) for c in ("family", "x", "y")]
        row, size, asks, linked = (np.asarray(table.column(c)) for c in ("row", "size", "asks", "linked"))
        lists = table.column("diff").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat, offs = np.asarray(lists.flatten()), np.asarray(lists.offsets) - lists.offsets[0].as_py()
        change = np.flatnonzero(np.any([v[1:] != v[:-1] for v in key], axis=0)) + 1
        left, right = [row[:0]], [row[:0]]
        for a, b in zip([0, *change.tolist()], [*change.tolist(), len(row)], strict=True):
            u, f = a + np.flatnonzero(asks[a:b]), a + np.flatnonzero(~asks[a:b])
            if not len(u) or not len(f):
                continue
            d = [flat[offs[i] : offs[i + 1]] for i in range(a, b)]
            n_u, n_f = (np.array([len(d[i - a]) for i in x], dtype=np.int64) for x in (u, f))
            differ = n_u[:, None] + n_f[None, :] - 2 * shared_counts([d[i - a] for i in u], [d[i - a] for i in f])
            ok = _close(size[u][:, None], size[f][None, :], differ, percent) & (row[u][:, None] != row[f][None, :])
            # Members that are linked with the head are one component: one link with any of them is enough.
            with_head = (ok & linked[f][None, :]).any(axis=1)
            left.append(row[u][with_head])
            right.append(key[0][u][with_head])
            others = np.flatnonzero(~linked[f])
            square = np.zeros((len(u) + len(others),) * 2, dtype=bool)
            square[: len(u), len(u) :] = ok[:, others]
            square |= square.T
            nodes = np.concatenate([row[u], row[f][others]])
            links = _spanning(square)
            left.append(nodes[[x for x, _ in links]] if links else row[:0])
            right.append(nodes[[y for _, y in links]] if links else row[:0])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    return run


def linked_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, for all pairs of sets."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    both = np.zeros((n, n), dtype=np.float32)
    if size.sum():
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(n), size)
        shared = np.bincount(column) > 1  # a shingle of one set is in no intersection
        keep = shared[column]
        row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        width = max(256, (1 << 20) // max(1, n))
        for c in range(0, int(shared.sum()), width):
            a, b = np.searchsorted(column, [c, c + width])
            m = np.zeros((n, width), dtype=np.float32)
            m[row[a:b], column[a:b] - c] = 1
            both += m @ m.T  # counts below 2^24 are exact
    inter = both.astype(np.int64)
    union = size[:, None] + size[None, :] - inter
    return (100 * inter >= percent * union) & (union > 0)


def _family_links(members: DataFrame, texts: DataFrame, shingle: int, percent: int, block: int, block_shingles: int) -> DataFrame:
    """(a, b): links that leave each family's members in the components that all their links would give.

    members: row, family, n, total (shingles of the family).  block, block_shingles: what a part of a family holds.
    """
    parts = F.ceil(F.greatest(F.col("n") / block, F.col("total") / block_shingles)).cast("int")
    own = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    at = F.when((F.col("row") == F.col("family")) & (F.col("parts") > 1), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    dealt = members.withColumn("parts", parts).join(texts.select("row", "text"), "row").withColumn("part", F.explode(at)).select("family", "part", "row", "parts", "text")
    stars = materialize(sorted_groups(dealt, ["family", "part"], ["row"], _star(shingle, percent), STARS, least=256, heavy=True), "stars")
    found = stars.where("other is not null").select(F.col("row").alias("a"), F.col("other").alias("b"))
    found = found.unionByName(stars.where("linked").select(F.col("row").alias("a"), F.col("family").alias("b")))
    wide = stars.where("diff is not null")
    sums = [F.count("*").alias("f"), F.sum(F.size("diff")).alias("fd"), F.sum((~F.col("linked")).cast("int")).alias("u"), F.sum(F.when(~F.col("linked"), F.size("diff"))).alias("ud")]
    open_ = materialize(wide.groupBy("family").agg(*sums).where("u > 0"), "open-families")
    blocks = lambda n, values: F.ceil(F.greatest(F.col(n) / (8 * block), F.col(values) / block_shingles)).cast("int")
    rows = wide.join(open_.withColumns({"nu": blocks("u", "ud"), "nf": blocks("f", "fd")}), "family")
    x, y = (F.pmod(F.xxhash64("row"), F.col(n)).cast("int") for n in ("nu", "nf"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["family", "row", "size", "linked", "diff"]
    asking = rows.where("not linked").select(*kept, F.lit(True).alias("asks"), x.alias("x"), every("nf").alias("y"))
    asked = rows.select(*kept, F.lit(False).alias("asks"), every("nu").alias("x"), y.alias("y"))
    rest = sorted_groups(asking.unionByName(asked), ["family", "x", "y"], ["row"], _rest(percent), "a long, b long")
    return found.unionByName(rest).where("a <> b").distinct()


def _judged(texts: DataFrame, shingle: int, percent: int, bands: int, slack: float, block: int, bucket_block: int, block_shingles: int) -> DataFrame:
    """texts (row, doc_id, text): row, doc_id, n_shingles, component (its smallest row) and component_id (its smallest doc_id) of each."""
    functions = bands * ROWS
    every = materialize(texts.mapInArrow(tidied(_sign(shingle, bands)), SIGNED), "signatures")
    # One row for each different set, under its smallest row.
    first = [F.min("row").alias("row"), F.min("doc_id").alias("least_id"), F.min_by("bits", "row").alias("bits"), F.min_by("bands", "row").alias("bands")]
    classes = materialize(every.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles").agg(*first), "classes")
    in_bands = classes.select("row", "bits", F.explode("bands").alias("bucket"))
    buckets = classes.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = _blocked(in_bands.join(materialize(buckets, "buckets"), "bucket"), "bucket", bucket_block)
    likely = sorted_groups(met, ["bucket", "x", "y"], ["row"], _families(percent / 100 - slack, functions), "a long, b long").distinct()
    likely = materialize(likely, "likely")
    family = components(likely).withColumnsRenamed({"id": "row", "component": "family"}).join(classes.select("row", "n_shingles"), "row")
    family = materialize(family, "families")
    sizes = materialize(family.groupBy("family").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total")), "family-sizes")
    links = materialize(_family_links(family.select("row", "family").join(sizes, "family"), texts, shingle, percent, block, block_shingles), "links")
    linked = components(links).withColumnsRenamed({"id": "row"})
    found = materialize(classes.select("set_a", "set_b", "n_shingles", "row", "least_id").join(linked, "row", "left").withColumn("component", F.coalesce("component", "row")), "linked-classes")
    least = found.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = found.join(materialize(least, "components"), "component").select("set_a", "set_b", "n_shingles", "component", "component_id")
    out = every.select("row", "doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("row", "doc_id", "n_shingles", "component", component.alias("component_id"))


def _with_rows(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    return docs.withColumn(name, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, bands: int = 25, slack: float = 0.25, block: int = 128, bucket_block: int = 1024, block_shingles: int = 500_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Documents are linked at 100 * intersection >= percent * union.  slack: an
    estimate so far under the threshold discards a pair.  block: so many members of
    a family, or so many that they hold block_shingles, are compared in one go;
    bucket_block: of a bucket, which holds only signatures.
    """
    texts = _with_rows(docs, id_col, text_col, "__row").select(F.col("__row").alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = _judged(texts, shingle, percent, bands, slack, block, bucket_block, block_shingles)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """docs with one row of each component, that of the smallest id; its own columns.

    Each row goes or stays by its own text.  Rows without an id or without words
    stay.  Of rows with equal id and text one stays, whichever its other columns are.
    """
    (row,) = fresh(docs, "__row")
    with_row = _with_rows(docs, id_col, text_col, row)
    texts = with_row.select(F.col(row).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    settings = {"bands": 25, "slack": 0.25, "block": 128, "bucket_block": 1024, "block_shingles": 500_000} | options
    judged = _judged(texts, shingle, percent, *settings.values()).where("doc_id is not null")
    rows = materialize(judged.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.min("component").alias("component"), F.count("*").alias("copies")), "judged")
    # The first of a component is its smallest id's row; of several texts under that id, the smallest hash's.
    first = rows.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "row"))["row"].alias("row"))
    gone = rows.where("component is not null").select("row").join(first.select(apart("row").alias("row")), "row", "left_anti")
    left = with_row.join(materialize(gone, "gone").withColumnRenamed("row", row), row, "left_anti")
    again = materialize(rows.where("copies > 1").select(F.col("row").alias(row)), "again")
    once = left.join(again, row, "left_anti").unionByName(left.join(again, row, "left_semi").dropDuplicates([row]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
