import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from wattloom.llm import lines, phrases, suffix_repeats

SCHEMA = "doc_id long, text string, n_bytes int, spans string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], SCHEMA)


def _byte_rows():
    random.seed(5)
    block = lambda n, alphabet="abc": "".join(random.choices(alphabet, k=n))
    shared, base = block(150), block(400)
    rows = [(1, base), (2, base[:170] + "é" + base[171:]), (3, block(60) + shared + block(90)), (4, block(100) + shared), (5, shared + block(70)), (6, None), (7, ""), (8, "short")]
    rows += [(9, "ab" * 300), (10, block(30) + "ab" * 60 + block(30)), (11, base), (11, base), (None, base), (12, block(3000, "abcdefgh"))]
    rows += [(20 + k, block(random.randrange(20)) + shared + block(random.randrange(20))) for k in range(12)]
    rows += [(40 + k, base[:200] + block(3) + base[203:]) for k in range(12)]
    return rows


@pytest.mark.parametrize("limit", [256, 2])
def test_repeated_bytes_against_brute_force(spark, limit):
    rows, size = _byte_rows(), 80
    counts = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        counts.update(raw[k : k + size] for k in range(len(raw) - size + 1) if i is not None)
    want = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - size + 1):
            if i is not None and counts[raw[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        runs = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(raw)))
        want.append((i, len(raw), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    got = suffix_repeats.repeated_bytes(_frame(spark, rows), size=size, limit=limit).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limit", [256, 2])
def test_repeated_phrases_against_brute_force(spark, limit):
    random.seed(6)
    vocabulary = ["a", "b", "C,", "dé", "x\u00a0y"]
    words = lambda n: [random.choice(vocabulary) for _ in range(n)]
    shared, base = words(16), words(60)
    texts = [(3, base), (5, base[:30] + ["new"] + base[30:]), (6, words(5) + shared + words(9)), (2, shared + words(3)), (9, base), (9, base), (10, words(400)), (11, ["a"] * 50), (12, ["b"] + ["a"] * 30), (4, shared + words(2) + shared)]
    texts += [(20 + k, words(k % 4) + shared + words(3)) for k in range(12)]
    rows = [(i, " \t\n"[i % 3].join(w)) for i, w in texts] + [(7, None), (8, ""), (13, " \n "), (None, " ".join(base))]
    size = 12
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[k : k + size])
            first[key] = min(i, first.get(key, i))
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = bytearray(len(w))
        for k in range(len(w) - size + 1) if i is not None else ():
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = b"\1" * size
        want.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    got = phrases.repeated_phrases(_frame(spark, rows), size=size, limit=limit).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def _plain_bytes(rows, size):
    counts = Counter(t.encode()[k : k + size] for _, t in rows if t for k in range(len(t.encode()) - size + 1))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - size + 1):
            if counts[raw[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        out.append((i, len(raw), sum(gone), hashlib.sha256(bytes(c for c, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [None, 3])
def test_repeats_with_nul_bytes(spark, limit):
    random.seed(21)
    text = lambda n: "".join(random.choices("abcdefghij", k=n))
    p = text(180)
    rows = [(1, "x" * 30 + p + "\0" * 20), *((2 + k, text(25) + p) for k in range(11)), (50, "y" * 31 + p + "\0" * 20)]
    rows += [(60, text(40) + p + "\0" * 10), (61, "\0" * 300), (62, "z" + "\0" * 250), (63, "\0" * 20 + p), (64, "\0" * 20 + p + "q")]
    for _ in range(2):
        got = suffix_repeats.repeated_bytes(_frame(spark, rows), limit=limit).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got), key=str) == _plain_bytes(rows, 200)
        random.shuffle(rows)


@pytest.mark.parametrize("limit", [None, 2])
def test_groups_hold_all_occurrences_of_a_maximal_repeat(spark, limit):
    random.seed(22)
    text = lambda n: "".join(random.choices("abcdefgh", k=n))
    size, core = 80, text(100)
    rows = [(1, "A" + core + "B"), (2, "C" + core + "B"), (3, "A" + core + "D"), (4, "E" + core[:85] + "F" + text(50)), (5, text(300)), (6, "A" + core + "B"), (7, text(30) + core + text(30) + core), (None, core)]
    texts = {i: t for i, t in rows}
    groups: dict[int, set] = {}
    for r in suffix_repeats.repeat_groups(_frame(spark, rows), size=size, limit=limit).collect():
        groups.setdefault(r["group"], set()).add((r["doc_id"], r["start"], r["length"]))
    found = set()
    for members in groups.values():
        (content,) = {texts[i][a : a + n] for i, a, n in members}
        every = {(i, a) for i, t in texts.items() if i is not None for a in range(len(t)) if t.startswith(content, a)}
        assert {(i, a) for i, a, _ in members} == every and len(every) > 1  # all occurrences, wherever they stand
        before, after = {texts[i][a - 1] if a else i for i, a, _ in members}, {texts[i][a + n : a + n + 1] or i for i, a, n in members}
        found.add((content, len(before) > 1, len(after) > 1))
    # A context reaches 16 bytes to the left and 80 to the right (less where a group was split), so some are cut there.
    assert all(size <= len(c) <= 96 for c, _, _ in found) and (limit or any(left and right for _, left, right in found))
    assert any(c in core[:85] for c, _, _ in found)
    removed = {(r["doc_id"]): r["spans"] for r in suffix_repeats.repeated_bytes(_frame(spark, rows), size=size, limit=limit).collect() if r["doc_id"]}
    for i, spans in removed.items():
        covered = {x for members in groups.values() for d, a, n in members if d == i for x in range(a, a + n)}
        assert covered == {x for s in spans for x in range(s["start"], s["end"])}


def test_texts_of_one_id_are_cut_each_by_its_own(spark):
    random.seed(23)
    words = lambda n: [random.choice("abcdefgh") + str(random.randrange(50)) for _ in range(n)]
    shared, other = words(30), words(25)
    rows = [(3, words(4) + shared), (3, words(9) + shared + words(3)), (5, shared), (5, other + words(2)), (1, other), (7, words(20)), (7, words(200) + other)]
    rows = [(i, " ".join(w)) for i, w in rows]
    size, first = 12, {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - size + 1):
            first[tuple(w[k : k + size])] = min(i, first.get(tuple(w[k : k + size]), i))
    want = []
    for i, t in rows:
        w = t.split()
        gone = {k + x for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for x in range(size)}
        want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    got = phrases.repeated_phrases(_frame(spark, rows), size=size).drop("spans").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    got = suffix_repeats.repeated_bytes(_frame(spark, rows), size=80).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == _plain_bytes(rows, 80)


def test_a_shard_locates_periodic_and_overlapping_passages():
    random.seed(24)
    for _ in range(200):
        alphabet = random.choice([["a"], ["a", "b"], list("abcde")])
        words = lambda n: random.choices(alphabet, k=n)  # noqa: B023, E731
        size = random.choice([3, 4, 7])
        passages = [words(random.randrange(1, 25)) for _ in range(random.randrange(1, 4))]
        text = words(random.randrange(40))
        known = {tuple(p[k : k + size]) for p in passages for k in range(len(p) - size + 1)}
        want = {k + x for k in range(len(text) - size + 1) if tuple(text[k : k + size]) in known for x in range(size)}
        shard = phrases.Shard([" ".join(p).encode() for p in passages], size)
        assert {x for a, b in shard.locate(" ".join(text).encode()) for x in range(a, b)} == want


def test_long_texts(spark):
    random.seed(25)
    long = " ".join(random.choice("abcdefgh") + str(random.randrange(500)) for _ in range(200_000))  # a megabyte
    rows = [(1, long), (2, long[500_000:700_000]), (3, "x " + long), (4, "other words")]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_repeats.repeated_bytes(_frame(spark, rows)).collect()}
    assert got == {1: len(long), 2: 200_000, 3: len(long), 4: 0}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in phrases.repeated_phrases(_frame(spark, rows)).collect()}
    assert got[1] == (200_000, 0) and got[3] == (200_001, 200_000) and got[2][0] - got[2][1] <= 2 and got[4] == (2, 0)
    text = "\n".join(f"line {k} {'w ' * 20}" for k in range(20_000))
    got = {r["doc_id"]: r["n_removed"] for r in lines.line_report(_frame(spark, [(1, text), (2, text), (3, "x" * 3_000_000), (4, "x" * 3_000_000)]), words=50).collect()}
    assert got == {1: 0, 2: 20_000, 3: 0, 4: 0}


def test_matches_name_the_place_they_repeat(spark):
    a = [f"a{k}" for k in range(9)]
    rows = [(1, a), (2, ["x", *a[2:7], "y"]), (3, [*a[0:3], "z", *a[2:7]]), (4, a[:2])]
    got = {tuple(r) for r in lines.matches(_frame(spark, [(i, "\n".join(w)) for i, w in rows])).drop("row").collect()}
    assert got == {(2, 1, 5, 1, 2), (3, 0, 3, 1, 0), (3, 4, 5, 1, 2)}


def test_intervals_are_those_of_the_common_prefixes():
    entries = sorted(["aab", "aabc", "aac", "b", "ba", "ba"])
    lcp = [0] + [len([1 for x, y in zip(a, b, strict=False) if x == y and a[: a.index(x) + 1] == b[: a.index(x) + 1]]) for a, b in zip(entries, entries[1:], strict=False)]
    lcp = [0, 3, 2, 0, 1, 2]
    assert sorted(suffix_repeats.intervals(lcp, 1)) == sorted([(3, 0, 1), (2, 0, 2), (1, 3, 5), (2, 4, 5)])


def test_fingerprints_of_one_place_are_dropped(spark):
    random.seed(31)
    line = lambda: "".join(random.choices("abcdefgh ", k=30))
    rows = [(k, "\n".join(line() for _ in range(38))) for k in range(200)]
    each = lambda rows, **kw: lines._repeated(lines._texts(_frame(spark, rows), "doc_id", "text"), 3, **kw)
    assert each(rows, words=None).count() == 0 and each(rows, words=2).count() == 0
    again = rows + [(500, "\n".join(rows[3][1].split("\n")[5:9] + [line()]))]
    assert 0 < each(again, words=None).count() < 40


def test_line_dedup_against_brute_force(spark):
    random.seed(7)
    line = lambda: random.choice(["", "one", "two é", "three", "four"])
    base = [f"line {k}" for k in range(8)]
    texts = [(4, "\n".join(base)), (2, "\n".join(base[2:7])), (5, "\n".join(["x", *base[1:5], "y"])), (6, None), (7, ""), (8, "\n"), (9, "\n\n\n\n"), (None, "\n".join(base)), (10, "one\ntwo"), (11, "\n".join(base)), (11, "\n".join(base))]
    texts += [(20 + k, "\n".join(line() for _ in range(random.randrange(30)))) for k in range(25)]
    size = 3
    first = {}
    for i, t in texts:
        w = t.split("\n") if t else []
        for k in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[k : k + size])
            first[key] = min((i, k), first.get(key, (i, k)))
    want = []
    for i, t in texts:
        w = t.split("\n") if t else []
        gone = {k + x for k in range(len(w) - size + 1) if i is not None and first[tuple(w[k : k + size])] < (i, k) for x in range(size)}
        kept = "\n".join(x for k, x in enumerate(w) if k not in gone) if gone else t
        want.append((i, kept, 1, "clash", len(w), len(gone)))
    got = lines.drop_repeated_lines(_frame(spark, texts), size=size).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("words", [6, 4])
def test_runs_of_many_words_against_brute_force(spark, words):
    random.seed(12)
    line = lambda: " ".join(random.choices(["a", "é", "c"], k=random.choice([0, 1, 2, 2, 3, 6, 7])))
    long, pair = "p q r s t u v", "one two three\nfour five six"
    texts = [(3, long), (2, long), (4, f"x\n{long}\ny"), (5, pair), (6, f"{pair}\nz"), (7, "one two three"), (None, long), (8, None), (9, ""), (10, "\n\n"), (11, pair), (11, pair), (12, f"{long}\n{long}")]
    texts += [(20 + k, "\n".join(line() for _ in range(random.randrange(12)))) for k in range(40)]
    size, first = 3, {}

    def runs(w):
        return [(k, n, tuple(w[k : k + n])) for n in range(1, size + 1) for k in range(len(w) - n + 1) if n == size or sum(len(x.split()) for x in w[k : k + n]) >= words]

    for i, t in texts:
        for k, _, key in runs(t.split("\n")) if t and i is not None else ():
            first[key] = min((i, k), first.get(key, (i, k)))
    want = []
    for i, t in texts:
        w = t.split("\n") if t else []
        gone = {k + x for k, n, key in runs(w) if i is not None and first[key] < (i, k) for x in range(n)}
        want.append((i, "\n".join(x for k, x in enumerate(w) if k not in gone) if gone else t, 1, "clash", len(w), len(gone)))
    got = lines.drop_repeated_lines(_frame(spark, texts), size=size, words=words).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_pipeline_drops_later_copies_of_long_lines(spark):
    passage, short = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(20))
    rows = [(1, f"{passage}\none"), (2, f"two\n{passage}"), (3, passage), (4, f"{short}\nfour"), (5, f"{short}\nfive")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_repeated_lines(spark, docs, "").collect()}
    assert left == {1: rows[0][1], 2: "two", 4: rows[3][1], 5: rows[4][1]}


@pytest.mark.parametrize("other", [None, "short", "y" * 700, "z q " * 200])
def test_an_id_on_two_rows(spark, other):
    random.seed(14)
    block = lambda n: "".join(random.choices("abcdefgh ", k=n))
    shared = block(300)
    one, two = block(40) + shared + block(50), block(70) + shared + block(60)
    rows = [(1, one), (1, other), (2, two), (3, other), (4, block(500))]
    size = 80
    whole = {r["doc_id"]: r["spans"] for r in suffix_repeats.repeated_bytes(_frame(spark, [(1, one), (2, two), (4, rows[4][1])]), size=size).collect()}
    got = suffix_repeats.repeated_bytes(_frame(spark, rows), size=size).collect()
    assert len(got) == len(rows)
    assert [r["spans"] for r in got if r["doc_id"] == 2] == [whole[2]] and whole[2]
    if other is None:
        assert sorted((r["doc_id"], r["n_removed"]) for r in got) == sorted([(1, sum(s["end"] - s["start"] for s in whole[1])), (1, 0), (2, sum(s["end"] - s["start"] for s in whole[2])), (3, 0), (4, 0)])
    shared = " ".join(random.choices("abcdefgh", k=40))
    rows = [(1, f"x y {shared} z"), (1, other), (2, f"u {shared} v w"), (4, "k l m " * 9)]
    got = phrases.repeated_phrases(_frame(spark, rows), size=12).collect()
    assert [[tuple(s) for s in r["spans"]] for r in got if r["doc_id"] == 2] == [[(1, 41)]]
    assert len(got) == len(rows)


def test_no_documents(spark):
    none = _frame(spark, [])
    assert suffix_repeats.repeated_bytes(none).count() == 0
    assert phrases.repeated_phrases(none).count() == 0
    assert lines.line_report(none).count() == 0
