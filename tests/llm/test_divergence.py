import random
import re
from collections import Counter

import numpy as np
import pytest

from wattloom.llm import divergence
from wattloom.llm.kernels import Words
from wattloom.llm.transducer import Transducer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _truth(rows, least, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    each = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))) for text, lang, source in rows]
    out = []
    for lang in {r[0] for r in each}:
        df = Counter(t for x, _, terms in each if x == lang for t in set(terms))
        kept = sorted((t for t, n in df.items() if n >= least), key=str.encode)
        counts = {s: Counter() for x, s, _ in each if x == lang}
        for x, s, terms in each:
            if x == lang:
                counts[s].update(t for t in terms if df[t] >= least)
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        far = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        for s in counts:
            ranked = sorted(((-sum(far(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s))
            out += [(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(ranked, 1)]
            ranked = sorted((-far(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(ranked, 1)]
    return sorted(out)


def _rows():
    random.seed(13)
    words = [f"{a}{b}" for a in "abcdé" for b in ("x", "yy", "zé", "", "日本")] + ["Ab", "AB", "x1y", "don't", "\U0001f600", "w" * 3000]
    rows = []
    for k in range(160):
        own = words[: 12 + k % 9]
        rows.append((random.choice(" \n-.\x7f").join(random.choices(own, k=random.randrange(60))), random.choice(["en", "de", None]), random.choice(["s1", "S1", "é", None, "z", "q"])))
    rows += [(None, "en", "s1"), ("", "fr", "alone"), ("rare words here", "it", "a"), (None, "it", "b"), ("12 34", "xx", "only"), ("a " * 40_000, "en", "é")]
    return rows + rows[:30]


@pytest.mark.parametrize(("shard", "block", "chunk"), [(1, 1, 1), (3, 2, 4), (1 << 15, 64, 2048)])
def test_audit_against_brute_force(spark, shard, block, chunk):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, `ordi.nal` int").repartition(5)
    got = divergence.audit(docs, least=4, top=3, shard_terms=shard, block=block, chunk=chunk).collect()
    assert sorted(map(tuple, got)) == _truth(rows, 4, 3)


def test_nothing_kept_and_nothing_at_all(spark):
    docs = spark.createDataFrame([("one", "en", "a"), ("two", "en", "b")], "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(docs).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.audit(docs.limit(0)).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    n, total, terms = 7 * 10**12 + 1, 9 * 10**14 + 7, 10**8 + 3
    frame = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert frame.select(divergence.share("n", "total", "terms")).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * terms)


def test_transducer_gives_ordinals_and_shares_states():
    random.seed(1)
    terms = sorted({"".join(random.choices("abcé", k=random.randrange(0, 9))).encode() for _ in range(3000)})
    made = Transducer.loaded(*Transducer.of(terms).stored())
    asked = terms + [t + b"q" for t in terms[:50]] + [t[:-1] for t in terms[:50]] + [b"zzz"]
    ends = np.cumsum([len(t) for t in asked])
    got = made.ordinals(np.frombuffer(b"".join(asked), np.uint8), ends - [len(t) for t in asked], ends)
    place = {t: k for k, t in enumerate(terms)}
    assert got.tolist() == [place.get(t, -1) for t in asked]
    endings = [a + b for a in (b"a", b"b", b"c") for b in (b"ing", b"ed", b"s")]
    assert len(Transducer.of(sorted(endings)).final) == 6  # start, one state for all stems, two within "ing", one within "ed", the end
    with pytest.raises(ValueError, match="rising"):
        Transducer.of([b"b", b"a"])
    none = Transducer.of([])
    assert none.ordinals(np.frombuffer(b"a", np.uint8), np.array([0, 0]), np.array([1, 0])).tolist() == [-1, -1]


def test_terms_that_share_a_hash_are_told_apart():
    buf = np.frombuffer(b"ab cd ab ef cd", np.uint8)
    words = Words(buf, np.array([0, len(buf)]), divergence.TERM_BYTES, lower=True)
    words._hash = np.zeros(5, np.uint64)
    kind, first = divergence._kinds(words)
    assert kind.tolist() == [0, 1, 0, 2, 1] and first.tolist() == [0, 1, 3]
