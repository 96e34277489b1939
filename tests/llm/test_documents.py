import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wattloom.llm import common, components, decontam, minhash, packing, token_files

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _near_rows():
    random.seed(8)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "x\u00a0y"]
    base = random.choices(vocabulary, k=60)
    rows = [(100, " ".join(base)), (7, " ".join(base).upper()), (None, " ".join(base)), (1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (8, " ".join(base)), (8, " ".join(base))]
    for k in range(40):
        w = list(base)
        for _ in range(random.randrange(8)):
            w[random.randrange(len(w))] = random.choice(vocabulary)
        rows.append((200 + k, " ".join(w)))
    return rows + [(300 + k, " ".join(random.choices(vocabulary, k=random.randrange(1, 90)))) for k in range(30)] + [(900, " ".join(random.choices(vocabulary, k=30_000)))]


def _near_truth(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(up)
    for a in ids:
        for b in ids:
            inter = len(sets[a] & sets[b])
            if a < b and inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), find(i) if i is not None else None, i is None or find(i) == i) for i, _ in rows]


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 85, 128), (5, 80, 4)])
def test_near_duplicates_against_brute_force(spark, k, percent, block):
    rows = _near_rows()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, component_id int, bands int")
    got = minhash.near_duplicates(docs, shingle=k, percent=percent, block=block, bucket_block=2 * block).collect()
    assert sorted(map(tuple, got), key=str) == sorted(_near_truth(rows, k, percent), key=str)


def test_texts_of_a_large_family_move_once(spark, monkeypatch):
    random.seed(18)
    vocabulary = [f"w{k}" for k in range(5000)]
    base = random.choices(vocabulary, k=80)
    rows = []
    for k in range(700):
        w = list(base)
        for _ in range(random.randrange(6)):
            w[random.randrange(len(w))] = random.choice(vocabulary)
        rows.append((1000 + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sent, plain = {}, minhash.sorted_groups

    def counted(df, keys, *rest, **options):
        sent[tuple(keys)] = df
        return plain(df, keys, *rest, **options)

    monkeypatch.setattr(minhash, "sorted_groups", counted)
    got = minhash.near_duplicates(docs, shingle=3, percent=85, block=16).collect()
    assert sorted(map(tuple, got)) == sorted(_near_truth(rows, 3, 85))
    members, parts = sent["family", "part"], 700 / 16
    assert members.count() <= 700 + parts + 2  # each member's text once, and the head's for each part


def test_rows_of_one_id_are_compared_each_by_its_own_text(spark):
    random.seed(19)
    words = lambda: random.choices([f"w{k}" for k in range(300)], k=60)
    a, b = words(), words()
    near = a[:-1] + ["changed"]
    rows = [(9, " ".join(a)), (9, " ".join(b)), (4, " ".join(near)), (12, " ".join(b)), (3, " ".join(words()))]
    got = {(r["doc_id"], i): r["component_id"] for i, r in enumerate(sorted(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect(), key=lambda r: (r["doc_id"], r["component_id"])))}
    assert got == {(3, 0): 3, (4, 1): 4, (9, 2): 4, (9, 3): 9, (12, 4): 9}


def test_pipeline_keeps_unique_texts_of_a_shared_id(spark):
    random.seed(15)
    words = lambda: " ".join(random.choices([f"w{k}" for k in range(300)], k=60))
    a, b, c, d, e = (words() for _ in range(5))
    near = a.rsplit(" ", 1)[0] + " changed"
    rows = [(1, a), (8, near), (8, b), (8, c), (8, c), (9, b), (9, d), (3, d), (None, a), (None, e), (7, e), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, component_id string")
    left = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert left.columns == docs.columns
    want = [(1, a), (8, b), (8, c), (3, d), (None, a), (None, e), (7, e), (4, None), (5, "")]
    assert sorted(((r[0], r[1]) for r in left.collect()), key=str) == sorted(want, key=str)


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    for share in (0.5, 0.9):
        n = int(2000 * 2 * share / (1 + share) / 2)
        both = [np.sort(h[:1000]), np.sort(np.concatenate([h[:n], h[1000 : 2000 - n]]))]
        m = minhash._minima(np.concatenate(both), np.array([1000, len(both[1])]), 25)
        agree = float((m[0] == m[1]).mean())
        true = n / (1000 + len(both[1]) - n)
        assert abs(agree - true) < 0.2


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(50)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(51)} | {100 + k: 100 for k in range(50)} | {200: 200, 201: 200}


def _contamination_truth(docs, items, share=20, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            size = min(window, len(v))
            for s in range(len(v) - size + 1) if size else ():
                for k in range(len(w) - size + 1):
                    if w[k : k + size] == v[s : s + size]:
                        hit.update(range(k, k + size))
                        found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and share * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("filter_bits", [24, 6])
def test_contamination_against_brute_force(spark, filter_bits):
    random.seed(9)
    vocabulary = ["alpha", "Beta", "gamma", "delta3", "É", "zeta"]
    words = lambda n: " ".join(random.choices(vocabulary, k=n))
    passage = words(30)
    items = [(1, passage), (2, "Alpha, beta!"), (10, words(14)), (3, None), (4, "?!"), (5, passage), (None, words(13)), (6, "beta")]
    docs = [(1, f"x {passage.upper()}, y"), (2, words(200) + passage), (3, None), (4, ""), (5, "..."), (6, "alpha-beta"), (7, words(9000) + " " + passage), (8, passage), (8, passage), (None, passage), (9, "beta")]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, words string")
    got = decontam.contamination(frame, bench, filter_bits=filter_bits).collect()
    want = _contamination_truth(docs, items)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    left = decontam.drop_contaminated(frame, bench, filter_bits=filter_bits)
    assert left.columns == frame.columns
    assert sorted((r[0] for r in left.collect()), key=str) == sorted((w[0] for w in want if not w[5]), key=str)


@pytest.mark.parametrize("filter_bits", [24, 6])
def test_dropping_judges_each_row_by_its_text(spark, filter_bits):
    random.seed(13)
    words = lambda n: " ".join(random.choices(["alpha", "beta", "gamma", "delta"], k=n))
    passage = words(30)
    items = [(1, passage), (2, words(20))]
    docs = [(1, passage), (None, passage), (None, passage), (None, "clean one"), (2, passage), (2, "clean two"), (2, None), (3, passage), (3, passage), (4, ""), (4, "clean three"), (4, "clean three"), (5, f"{passage} {'x ' * 700}")]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, n_words string")
    left = decontam.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"), filter_bits=filter_bits)
    want = [(i, t, "clash") for (i, t), w in zip(docs, _contamination_truth(docs, items), strict=True) if not w[5]]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)
    clashing = frame.withColumns({n: F.lit("own") for n in ("__row", "__bad", "__contaminated", "row", "s", "at", "words")})
    assert decontam.drop_contaminated(clashing, spark.createDataFrame(items, "item_id long, text string"), filter_bits=filter_bits).columns == clashing.columns
    named = decontam.drop_contaminated(frame.withColumn("doc_id", F.col("doc_id").cast("string")), spark.createDataFrame(items, "item_id long, text string"), filter_bits=filter_bits)
    assert named.count() == len(want)


def test_packing_is_best_fit_decreasing():
    random.seed(10)
    for _ in range(30):
        capacity = random.choice([10, 64, 1024])
        lengths = [random.randint(1, capacity) for _ in range(random.randrange(200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        bins: list[int] = []
        for n in sorted(lengths, reverse=True):
            fits = [k for k, gap in enumerate(bins) if gap >= n]
            k = min(fits, key=lambda b: bins[b]) if fits else len(bins)
            if not fits:
                bins.append(capacity)
            bins[k] -= n
        placed: dict[int, list] = {}
        for length, _, n, first, offset in packing.sweeps(counts, capacity).tolist():
            for b in range(first, first + n):
                placed.setdefault(b, []).append((offset, length))
        assert len(placed) == len(bins)
        assert sorted(x[1] for v in placed.values() for x in v) == sorted(lengths)
        for v in placed.values():
            at = 0
            for offset, length in sorted(v):
                assert offset == at
                at += length
            assert at <= capacity
    with pytest.raises(ValueError):
        packing.sweeps({11: 1}, 10)


def _texts():
    random.seed(11)
    return [(5, None), (3, ""), (4, "One two, three!"), (2, " ".join(random.choices(["alpha", "beta", "Übung."], k=3000))), (9, "x\ny"), (9, "x\ny"), (None, "no id"), (1, "one")]


def test_packed_documents(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t, 1) for i, t in _texts()], "doc_id long, text string, length int")
    pieces = packing.token_pieces(docs, tokenizer=path, end_id=2, capacity=64, with_ids=True)
    rows = packing.best_fit(pieces, capacity=64).collect()
    whole = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in _texts()}
    for r in rows:
        ids = whole[r["doc_id"]]
        part = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
        assert bytes(r["ids"]) == part and r["ids_crc32"] == zlib.crc32(part) and len(part) == 4 * r["length"]
        assert r["length"] == 64 or r["piece"] == 0
    assert sum(r["length"] for r in rows) == sum(len(whole[i]) for i, _ in _texts())
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in by.values():
        ends = [a + n for a, n in sorted(v)]
        assert [a for a, _ in sorted(v)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert packing.best_fit(packing.token_pieces(docs.limit(0), tokenizer=path, end_id=2, capacity=64), capacity=64).count() == 0


def test_token_files_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t, 1) for i, t in _texts()], "doc_id long, text string, start int")
    folder = common.new_folder(spark, "tokens")
    manifest = token_files.write_token_files(docs, folder, tokenizer=path, end_id=1)
    got = token_files.read_token_files(manifest).collect()
    small = token_files.write_token_files(docs.coalesce(1), common.new_folder(spark, "tokens"), tokenizer=path, end_id=1, shard_tokens=5, shard_docs=2)
    assert small.count() > manifest.count() and small.where("n_docs > 2").count() == 0
    assert sorted(map(tuple, token_files.read_token_files(small, run_docs=1, run_tokens=1).collect()), key=str) == sorted(map(tuple, got), key=str)
    first = manifest.orderBy("base").first()
    with open(first["path"].removeprefix("file://") + ".idx", "rb") as f:
        assert len(f.read()) == 8 * (first["n_docs"] + 1)

    class Store:  # not a local one
        def open_input_file(self, name):
            return pa.OSFile(name)

    ranges = token_files._Ranges(Store(), first["path"].removeprefix("file://") + ".idx", "<u8")
    assert ranges(first["n_docs"], first["n_docs"] + 1).tolist() == [first["n_tokens"]]
    at, want = 0, []
    for i, t in sorted(_texts(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    empty = token_files.write_token_files(docs.limit(0), common.new_folder(spark, "tokens"), tokenizer=path, end_id=1)
    assert token_files.read_token_files(empty).count() == 0


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert minhash.near_duplicates(none).count() == 0
    assert decontam.contamination(none, items).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r)[1:4] for r in decontam.contamination(some, items).collect()] == [(2, 0, 0)]


def test_packing_takes_columns_of_any_name(spark):
    pieces = spark.createDataFrame([(k, 1 + k % 9, "x", 1, 2) for k in range(200)], "id int, `le.ngth` long, __task string, `rank` int, whole_rank int")
    rows = packing.best_fit(pieces, length_col="le.ngth", capacity=10).collect()
    assert sorted(r["id"] for r in rows) == list(range(200)) and {r["__task"] for r in rows} == {"x"}
    for number in {r["sequence_id"] for r in rows}:
        held = sorted((r["offset"], r["le.ngth"]) for r in rows if r["sequence_id"] == number)
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) <= 10
