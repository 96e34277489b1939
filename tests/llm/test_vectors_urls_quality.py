import math
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.llm import ann_onebit, lines, quality, queries, urls
from wattloom.llm.kernels import BYTE_VALUES, RangeHasher, mix

SF = "/root/testdata/sf0.001"


def test_nearest_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    m = rng.standard_normal((400, 16)).astype(np.float32)
    m[50] = m[7]
    m[51] = 2 * m[7]
    vectors = [(k, [float(x) for x in v]) for k, v in enumerate(m)]
    odd = [(1000, None), (1050, [0.0] * 16), (1100, [math.nan] + [1.0] * 15), (1150, [math.inf] + [1.0] * 15), (1200, [None] + [1.0] * 15), (1250, [1.0] * 3), (None, [1.0] * 16), (1300, [])]
    table = spark.createDataFrame([(i, v, 0) for i, v in vectors + odd], "vec_id long, embedding array<float>, score int")
    index = ann_onebit.build_index(table, dims=16)
    got: dict[int, list] = {}
    for r in ann_onebit.search(index, index.where("vec_id % 50 = 0"), k=5, dims=16, query_block=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    d = m.astype(np.float64)
    unit = d / np.linalg.norm(d, axis=1)[:, None]
    assert sorted(got) == list(range(0, 400, 50))
    for q, rows in got.items():
        score = unit @ unit[q]
        want = sorted((k for k in range(400) if k != q), key=lambda k: (-round(score[k], 12), k))[:5]
        assert [v for _, v, _ in sorted(rows)] == want
        assert all(abs(s - score[v]) < 1e-12 for _, v, s in rows)
    few = index.where("vec_id < 3")
    assert ann_onebit.search(few, few.where("vec_id = 0"), k=5, dims=16).count() == 2
    assert ann_onebit.search(index.limit(0), index.limit(0), dims=16).count() == 0


def test_query_answers_for_vectors_of_every_length(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = [(k, rng.standard_normal(16 if k < 300 else 8).tolist()) for k in range(599)] + [(600, [1.0, 2.0, 3.0]), (650, None), (700, [])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got: dict[int, list] = {}
    for r in queries.op2_onebit_ann(spark, str(tmp_path)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(got) == list(range(0, 599, 50))
    for q, found in got.items():
        v = np.array(rows[q][1])
        others = [(i, np.array(x)) for i, x in rows[:599] if i != q and len(x) == len(v)]
        want = sorted(others, key=lambda o: (-round(o[1] @ v / np.linalg.norm(o[1]) / np.linalg.norm(v), 12), o[0]))[:5]
        assert [i for _, i in sorted(found)] == [i for i, _ in want]


def test_a_small_share_is_scored_exactly_and_recall_is_high(spark):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.01/embeddings.parquet")
    m = np.array(table.column("embedding").to_pylist(), dtype=np.float64)
    ids = np.array(table.column("vec_id").to_pylist())
    rng = np.random.default_rng(6)  # more of their kind, so that shares mean something
    m = np.concatenate([m, m[rng.integers(0, len(m), 4000)] + 0.5 * m.std() * rng.standard_normal((4000, m.shape[1]))])
    ids = np.concatenate([ids, ids.max() + 1 + np.arange(4000)])
    index = ann_onebit.build_index(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, m, strict=True)], "vec_id long, embedding array<double>"), dims=m.shape[1])
    queries = index.where("vec_id % 50 = 0")
    scored, _, _ = ann_onebit.candidates(index, queries, dims=m.shape[1], chunk=1000, query_block=16)
    n_queries = int((ids % 50 == 0).sum())
    assert scored.count() < 0.1 * n_queries * len(ids)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    got: dict[int, set] = {}
    for r in ann_onebit.search(index, queries, dims=m.shape[1], chunk=1000, query_block=16).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for at in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[at]
        s[at] = -9
        hits += len(got[int(ids[at])] & set(ids[np.argsort(-s)[:5]].tolist()))
    assert hits >= 0.97 * 5 * n_queries


def test_rows_that_share_an_id_are_queries_and_candidates_of_their_own(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.9, 0.1, 0.0], [0.0, 1.0, 0.0]
    rows = [(50, a), (50, a), (50, b), (1, c), (2, [2.0, 0.0, 0.0]), (3, None), (4, [1.0, 2.0])]
    index = ann_onebit.build_index(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), dims=3)
    got: dict[tuple, list] = {}
    for r in ann_onebit.search(index, index.where("vec_id = 50"), k=2, dims=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 6)))
    near = round(0.9 / math.hypot(0.9, 0.1), 6)
    assert sorted(got[50]) == sorted([(1, 2, 1.0), (2, 50, 1.0)] * 2 + [(1, 2, near), (2, 50, near)])


def test_estimates_keep_to_their_bounds():
    rng = np.random.default_rng(5)
    m = rng.standard_normal((2000, 64))
    q = rng.standard_normal((20, 64))
    turn = ann_onebit.rotation(64, 7)
    assert np.allclose(turn @ turn.T, np.eye(64))
    code, norm, c = ann_onebit.encode(m, turn)
    assert np.allclose(norm, np.linalg.norm(m, axis=1))
    signs = np.unpackbits(code, axis=1).astype(float) * 2 - 1
    unit = m / norm[:, None]
    uq = q / np.linalg.norm(q, axis=1)[:, None]
    off = np.abs(uq @ turn.T / 8 @ signs.T / c - uq @ unit.T)
    assert (off <= 4 * np.sqrt((1 - c**2) / c**2 / 63)).mean() > 0.999


def _verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k])
        path = rest[k:].split("?")[0].split("#")[0]
    best = max((r for r in rules if (host == r[2] or host.endswith("." + r[2])) and path.startswith(r[3])), key=lambda r: (len(r[2] + r[3]), len(r[2])), default=None)
    return host, path, best and best[1], best[0] if best else "allow"


def test_a_frequent_url_is_split_and_null_urls_are_dealt(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        url = F.when(F.col("id") % 10 < 6, "http://a.net/fr/x").when(F.col("id") % 10 < 9, F.lit(None)).otherwise(F.concat(F.lit("http://b.com/"), F.col("id")))
        pages = spark.range(60_000).select(F.col("id").alias("page_id"), url.alias("url"), F.sha2(F.col("id").cast("string"), 256).alias("__spread")).repartition(12)
        found = urls.filter_urls(pages, urls.make_rules(spark, queries.URL_RULES))
        counts = {(r["rule"], r["verdict"]): r["count"] for r in found.groupBy("rule", "verdict").count().collect()}
        assert counts == {("net/fr/", "block"): 36_000, (None, "allow"): 18_000, ("com/", "allow"): 6_000}
        rows = found.collect()
        assert len(rows) == 60_000 and "skew=true" in found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_url_rules_against_brute_force(spark):
    given = queries.URL_RULES + [("block", "a.b.example.org/x/y"), ("allow", "example.org/x"), ("block", "org/x/y/z")]
    rules = urls.make_rules(spark, given)
    rows = [r.asDict() for r in rules.collect()]
    plain = [(r["verdict"], r["rule"], r["host"], r["path"]) for r in rows]
    tests = [None, "", "no scheme", "://", "http://", "http://COM/", "http://example.com/en/1", "http://www.Example.com/en/", "https://x.www.example.com/en/a?b#c", "http://xexample.com/en/", "http://a.net/es/?q", "http://a.net/es", "http://a.net/ES/", "ftp://u:p@b.com:80/x", "http://c.com?x=/en/", "http://a.b.example.org/x/yy", "http://b.example.org/x/y/z/", "http://.com/", "http://é.com/é", "a://b://example.com/en/", "http://" + "a." * 300 + "com/" + "x" * 5000]
    pages = spark.createDataFrame([(k, u, "h", "clash") for k, u in enumerate(tests + tests[:8])], "page_id long, url string, html string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(pages, rules).collect()}
    assert got == {k: _verdict(u, plain) for k, u in enumerate(tests + tests[:8])}
    assert {r["verdict"] for r in urls.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert urls.filter_urls(pages.limit(0), rules).count() == 0


def _corpus(spark):
    random.seed(12)
    rows, labels = [], []
    for k in range(600):
        words = [random.choice(["lorem", "ipsum", "dolor", "sit", "amet", f"w{random.randrange(400)}"]) for _ in range(60)]
        bad, nasty = k % 5 == 0, k % 7 == 0
        if bad:
            words = [w + "###" for w in words]
        if nasty:
            words[k % 50] = "vileword"
        rows.append((k, " ".join(words), f"s{k % 3}" if k % 11 else None, "en" if k % 2 else None, "clash"))
        labels.append((k, int(not bad), int(nasty)))
    rows += [(None, "lorem ipsum", "s1", "en", "clash"), (700, None, "s1", "en", "clash"), (701, "", "s9", "en", "clash"), (1, rows[1][1], "s1", "en", "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, __h string"), spark.createDataFrame(labels[:400] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def test_quality_on_rows_without_labels(spark):
    docs, labels = _corpus(spark)
    judged = quality.judge(docs, labels, sample=300).collect()
    assert len(judged) == 604
    for r in judged:
        if r["doc_id"] is not None and 400 <= r["doc_id"] < 600:
            assert r["__keep"] == (r["doc_id"] % 5 != 0 and r["doc_id"] % 7 != 0), r
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.keep_good(docs, labels.limit(0)).count() == 604
    assert quality.keep_good(docs.limit(0), labels).count() == 0


def test_clashing_names(spark):
    docs, labels = _corpus(spark)
    names = ["__p", "__keep", "__z_low", "__host", "__p_low", "__low", "__site", "host", "path", "low", "toxic", "keep", "p_low", "__P_TOXIC"]
    clashing = docs.withColumns({n: F.lit(f"own {n}") for n in names})
    left = quality.keep_good(clashing, labels, sample=300)
    assert left.columns == clashing.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted((r["doc_id"] for r in quality.keep_good(docs, labels, sample=300).collect()), key=str)
    assert {r["__keep"] for r in left.collect()} == {"own __keep"}
    pages = spark.createDataFrame([(1, "http://a.net/es/x", "p", "q", "r")], "page_id long, url string, __hit string, __url string, rule string")
    assert [tuple(r) for r in urls.filter_urls(pages, urls.make_rules(spark, queries.URL_RULES)).collect()] == [(1, "http://a.net/es/x", "p", "q", "a.net", "/es/x", "net/es/", "block")]
    texts = spark.createDataFrame([(k, "a\nb\nc", "own") for k in (1, 2)], "doc_id long, text string, __starts string")
    texts = texts.withColumns({n: F.lit("own") for n in ("__id", "__row", "__runs", "__n_lines", "__n_removed", "f", "w", "v", "at", "n", "row", "first")})
    cut = lines.drop_repeated_lines(texts)
    assert cut.columns[:-2] == texts.columns and len(set(cut.columns)) == len(cut.columns)
    assert sorted((r["doc_id"], r["text"], r["__n_removed"], r[-1]) for r in cut.collect()) == [(1, "a\nb\nc", "own", 0), (2, "", "own", 3)]


def _plain_evidence(text, model):
    """Log odds from the words and style of one text, by plain string work."""
    import re

    out = [float(b) for b in model.bias]
    low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def hashed(b, extra):
        h = RangeHasher(BYTE_VALUES[np.frombuffer(b, np.uint8)])(np.array([0]), np.array([len(b)]))
        return int(mix(h + np.uint64(extra))[0])

    keys = {hashed(w.encode(), 1) for w in words} | {hashed(w.encode()[:k], k) for w in words for k in (4, 5) if len(w.encode()) > k}
    v = text.split(" ")
    v = [x for part in v for x in part.split("\n") if x]
    raw = text.encode()
    symbols = set("|#$%&*@^~<>{}=+[]\\_")
    n = len(v)
    style = [sum(x[-1] in ".!?" for x in v) / n, sum(bool(set(x) & symbols) for x in v) / n, len(set(v)) / n, sum(a == b for a, b in zip(v, v[1:], strict=False)) / n]
    style += [sum(c in symbols for c in text) / len(raw), sum("A" <= c <= "Z" for c in text) / len(raw), sum("0" <= c <= "9" for c in text) / len(raw), min(1, math.log2(n) / 16), min(1, len(raw) / n / 20)]
    steps = [0.0, 0.002, 0.01, 0.03, 0.06, 0.12, 0.2, 0.3, 0.45, 0.6, 0.8]
    for k, x in enumerate(style):
        keys.add(int(mix(np.array([sum(s <= x for s in steps) + 100 * (k + 1)], dtype=np.uint64) + np.uint64(1 << 50))[0]))
    for j, key in enumerate(model.lookup.keys.tolist()):
        if key in keys:
            out = [o + float(model.weights[t, j]) for t, o in enumerate(out)]
    return out


def test_evidence_against_plain_strings(spark):
    import pyarrow as pa

    docs, labels = _corpus(spark)
    model = quality.fit(docs, labels, sample=300)
    texts = [r["text"] for r in docs.limit(25).collect()] + ["Über DAS, ist es. it's!? x x x 99", "one"]
    got = model.evidence(pa.array(texts))
    assert np.abs(model.weights).sum() > 0
    for k, t in enumerate(texts):
        assert np.allclose(got[:, k], _plain_evidence(t, model), atol=1e-9), t
    assert np.allclose(model.evidence(pa.array([None, ""], pa.string())), model.bias[:, None])


def test_site_rates_against_plain_arithmetic(spark):
    random.seed(13)
    rows = [(f"h{k % 4}", f"p{k % 3}", random.random(), random.random() / 10) for k in range(200)] + [("lone", "p", 0.9, 0.1)]
    scores = spark.createDataFrame(rows, "host string, path string, p_low double, p_toxic double")
    sites, about = quality.site_rates(scores)
    sites = sites.select("host", "path", F.struct("*").alias("site"))
    z = F.log(F.col("p_low") / (1 - F.col("p_low")))
    full = scores.join(sites, ["host", "path"])
    got = {(r["host"], r["path"], r["p_low"]): r["z"] for r in full.withColumn("z", quality.posterior(z, F.col("p_low"), F.col("site"), "low", about)).collect()}
    a, mu = about["low"], np.mean([r[2] for r in rows])
    assert abs(a["rate"] - mu) < 1e-12 and a["host"] >= 2 and a["path"] >= 2
    for h, p, x, _ in rows:
        host = [r[2] for r in rows if r[0] == h]
        path = [r[2] for r in rows if r[:2] == (h, p)]
        mh = (a["host"] * mu + sum(host) - x) / (a["host"] + len(host) - 1)
        mp = (a["path"] * mh + sum(path) - x) / (a["path"] + len(path) - 1)
        zz = math.log(x / (1 - x)) + math.log(mp / (1 - mp)) - math.log(mu / (1 - mu))
        assert abs(got[h, p, x] - 1 / (1 + math.exp(-zz))) < 1e-9


def test_every_query_is_named_after_its_operator():
    names = {int(n[2:].split("_")[0]) for n in queries.QUERIES}
    assert names == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def stages(spark):
    sys.path.insert(0, str(Path(__file__).parent.parent.parent))
    import corpus_pipeline as p
    from wattloom.llm.common import materialize

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in p.STAGES:
        after = materialize(stage(spark, docs, SF), "stage")
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after
    return out


def test_pipeline_stages_against_brute_force(stages, spark):
    from .test_documents import _contamination_truth, _near_truth

    before, after = stages["quality classifier"]
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    known = [r["doc_id"] for r in before if r["doc_id"] in labels]
    right = [(i in kept) == (labels[i]["quality"] == 1 and labels[i]["toxic"] == 0) for i in known]
    assert np.mean(right) > 0.95 and all(r in before for r in after)

    before, after = stages["line dedup"]
    first = {}

    def runs(lines):  # three lines, or fewer of 50 words
        return [(k, n) for n in (1, 2, 3) for k in range(len(lines) - n + 1) if n == 3 or sum(len(x.split()) for x in lines[k : k + n]) >= 50]

    for r in before:
        w = r["text"].split("\n")
        for k, n in runs(w):
            first[tuple(w[k : k + n])] = min((r["doc_id"], k), first.get(tuple(w[k : k + n]), (r["doc_id"], k)))
    want = {}
    for r in before:
        w = r["text"].split("\n")
        gone = {k + x for k, n in runs(w) if first[tuple(w[k : k + n])] < (r["doc_id"], k) for x in range(n)}
        text = "\n".join(x for k, x in enumerate(w) if k not in gone)
        if not gone or text.strip(" "):
            want[r["doc_id"]] = r | {"text": text, "n_chars": len(text)}
    assert {r["doc_id"]: r for r in after} == want

    before, after = stages["near-duplicate removal"]
    truth = _near_truth([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert {r["doc_id"] for r in after} == {t[0] for t in truth if t[3]}

    before, after = stages["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    truth = _contamination_truth([(r["doc_id"], r["text"]) for r in before], items)
    assert {r["doc_id"] for r in after} == {t[0] for t in truth if not t[5]}

    before, after = stages["best-fit packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    assert all(0 < r["length"] <= 1024 and r["offset"] + r["length"] <= 1024 for r in after)


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    import corpus_pipeline as p
    from wattloom.llm.common import materialize

    random.seed(31)
    words = lambda n: " ".join(random.choices(["lorem", "ipsum", "dolor", "sit", "amet", "magna"], k=n))
    passage = words(40)
    texts = [(1, words(50)), (None, words(30)), (None, None), (2, None), (3, ""), (4, words(4000)), (5, words(20)), (5, words(25)), (6, passage), (None, passage), (7, "x\ny"), (7, "x\ny"), (8, "\0 \0"), (9, "\n\n\n\n")]
    clashes = ["__row", "__runs", "__id", "__n_removed", "__keep", "__host", "component_id", "row", "n_hit", "__contaminated"]
    rows = [(i, t, None if k % 4 == 0 else "en", "s" if k % 3 else None, len(t or ""), *["own"] * len(clashes)) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clashes))
    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (5, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for name, stage in p.STAGES[:-1]:
        after = materialize(stage(spark, kept, str(tmp_path)), "odd")
        assert after.columns == docs.columns and {r["__keep"] for r in after.collect()} == {"own"}, name
        assert stage(spark, kept.limit(0), str(tmp_path)).count() == 0
        kept = after
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert (None, None) in left and (2, None) in left and (1, texts[0][1]) in left and len([x for x in left if x[0] == 5]) == 2
    assert not [x for x in left if x[1] == passage] and len([x for x in left if x[0] == 7]) == 1
    packed = p.STAGES[-1][1](spark, kept, str(tmp_path)).collect()
    assert len({(r["doc_id"], r["start"], r["ids_crc32"]) for r in packed}) >= len(set(left)) - 3 and all(r["offset"] + r["length"] <= 1024 for r in packed)
    assert p.STAGES[-1][1](spark, kept.limit(0), str(tmp_path)).count() == 0
