"""Quality classifier with hierarchical empirical Bayes.

Two things are judged for each document: whether it is of low quality, and
whether it is toxic.  A document's own evidence is a logistic regression over its
words, the beginnings of its words, and its style (shares of symbols, capitals,
sentence ends, repeated words and the like, in steps).  Which features take part
is decided by counts over the labelled sample, grouped by feature.

The evidence is then combined with where the document comes from.  Posterior
sums are grouped by host and by path within the host.  A host's rate is shrunk
towards the global rate and a path's towards its host's, with strengths that are
themselves estimated from how far rates lie apart (by the method of moments), so a
site of few documents says little.  A document's own posterior is left out of
its site's rate.  The site's log odds against the global ones are added to the
document's.

The regression is fitted on at most `sample` labelled rows (those with the
smallest hashed ids), with the n_features strongest features of each target among
those that at least five labelled rows have; everything else covers all
documents.  Each text is scored once.

Edge cases: a null or empty text has no features, so only the intercept and its
site speak; host and path that are null are taken as the empty string.  Documents
whose id is null are judged like others.  Without labels, or with labels of one
kind, nothing is rejected on that count.  Labels that repeat an id are united
(toxic if any is, low if any is).  Repeated rows each get the same judgement.
Other columns, whatever their names, go through.  No documents: no rows.  A
worker needs about 60 bytes for each byte of its longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, fresh, materialize, tidied
from .kernels import ALNUM, BYTE_VALUES, Lookup, NOT_SPACE, RangeHasher, U64, Words, mix, signed, text_blocks

TARGETS = ("low", "toxic")
_END = np.zeros(256, dtype=np.int64)
_END[[ord(c) for c in ".!?"]] = 1
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[ord(c) for c in "|#$%&*@^~<>{}=+[]\\_"]] = 1
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[0x41:0x5B] = 1
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[0x30:0x3A] = 1
_STEPS = np.array([0.0, 0.002, 0.01, 0.03, 0.06, 0.12, 0.2, 0.3, 0.45, 0.6, 0.8])


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) pairs of a block; words may repeat."""
    n_docs = len(offs) - 1
    w = Words(buf, offs, ALNUM, lower=True)
    doc = np.repeat(np.arange(n_docs), w.counts)
    h = RangeHasher(BYTE_VALUES[w.buf])
    size = w.ends - w.starts
    docs, keys = [doc], [mix(h(w.starts, w.ends) + U64(1))]
    for k in (4, 5):
        long = size > k
        docs.append(doc[long])
        keys.append(mix(h(w.starts[long], w.starts[long] + k) + U64(k)))
    # style
    v = Words(buf, offs, NOT_SPACE)
    words = v.counts
    vdoc = np.repeat(np.arange(n_docs), words)
    total = np.maximum(1, words)
    sums = lambda t: np.concatenate([[0], np.cumsum(t[buf])])
    per = lambda flags: np.bincount(vdoc, weights=flags, minlength=n_docs) / total
    marks = sums(_SYMBOL)
    chars = np.maximum(1, np.diff(offs))
    order = np.lexsort((v.hash, vdoc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (v.hash[order][1:] != v.hash[order][:-1]) | (vdoc[order][1:] != vdoc[order][:-1])
    runs = np.zeros(len(vdoc), dtype=bool)
    runs[1:] = (v.hash[1:] == v.hash[:-1]) & (vdoc[1:] == vdoc[:-1])
    share = lambda t: np.diff(sums(t)[offs]) / chars
    style = [
        per(_END[buf[v.ends - 1]] if len(v.ends) else v.ends),
        per(marks[v.ends] > marks[v.starts]),
        np.bincount(vdoc[order][new], minlength=n_docs) / total,
        per(runs),
        share(_SYMBOL),
        share(_UPPER),
        share(_DIGIT),
        np.minimum(1, np.log2(total) / 16),
        np.minimum(1, chars / total / 20),
    ]
    some = np.flatnonzero(words)
    for k, values in enumerate(style):
        step = np.searchsorted(_STEPS, values[some], side="right")
        docs.append(some)
        keys.append(mix((step + 100 * (k + 1)).astype(U64) + U64(1 << 50)))
    return np.concatenate(docs), np.concatenate(keys)


def _count(batches):
    """Of labelled documents: for each feature, how many have it, how many of those are low and toxic."""
    for batch in batches:
        low, toxic = np.asarray(batch.column(1), dtype=np.int64), np.asarray(batch.column(2), dtype=np.int64)
        parts = []
        for i, _, buf, offs in text_blocks(batch.column(0)):
            doc, key = features(buf, offs)
            pairs = np.unique(np.stack([key, doc.astype(U64)]), axis=1) if len(key) else np.zeros((2, 0), U64)
            d = pairs[1].astype(np.int64) + i
            parts.append((pairs[0], low[d], toxic[d]))
        if not parts:
            continue
        key, lo, to = (np.concatenate(x) for x in zip(*parts, strict=True))
        known, back = np.unique(key, return_inverse=True)
        columns = [np.bincount(back, weights=x, minlength=len(known)).astype(np.int64) for x in (np.ones(len(key)), lo, to)]
        yield pa.RecordBatch.from_arrays([pa.array(signed(known)), *map(pa.array, columns)], names=["f", "n", "n_low", "n_toxic"])


def _strength(n: Column, hits: Column, total: int, positive: int) -> Column:
    """How many standard errors the feature's share among positives and the others lie apart."""
    a, b = hits / F.lit(float(positive)), (n - hits) / F.lit(float(total - positive))
    p = (n / F.lit(float(total))) * (1 - n / F.lit(float(total)))
    return F.abs(a - b) / F.sqrt((p + F.lit(1e-9)) * F.lit(1 / positive + 1 / (total - positive)))


class Model:
    """Weights of the chosen features for each target; small, and sent to the tasks."""

    def __init__(self, keys: np.ndarray):
        self.lookup = Lookup(keys)
        self.weights = np.zeros((len(TARGETS), len(self.lookup.keys)))
        self.bias = np.full(len(TARGETS), -6.0)

    def present(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, feature number) pairs."""
        doc, key = features(buf, offs)
        at, f = self.lookup.find(key)
        pairs = np.unique(doc[at] * max(1, len(self.lookup.keys)) + f)
        return np.divmod(pairs, max(1, len(self.lookup.keys)))

    def evidence(self, column: pa.Array) -> np.ndarray:
        """Log odds of each target for each text."""
        out = np.zeros((len(TARGETS), len(column))) + self.bias[:, None]
        for i, j, buf, offs in text_blocks(column):
            doc, f = self.present(buf, offs)
            for t in range(len(TARGETS)):
                out[t, i:j] += np.bincount(doc, weights=self.weights[t, f], minlength=j - i)
        return out


def _regress(doc: np.ndarray, feature: np.ndarray, n_features: int, y: np.ndarray, rounds: int = 250, ridge: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 features by full-batch Adam."""
    w = np.zeros(n_features + 1)
    w[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for r in range(1, rounds + 1):
        z = np.bincount(doc, weights=w[feature], minlength=len(y)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(feature, weights=error[doc], minlength=n_features), error.sum())
        g[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = 10_000, n_features: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """labels: doc_id, quality (1: good), toxic (1: toxic)."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("low"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).na.fill(0)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # at most `sample` rows of three numbers
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "low", "toxic")
    texts = materialize(texts, "labelled")
    total, *positive = texts.agg(F.count("*"), *[F.coalesce(F.sum(t), F.lit(0)) for t in TARGETS]).first()
    usable = [t for t in range(len(TARGETS)) if 0 < positive[t] < total]
    counts = materialize(texts.mapInArrow(tidied(_count), "f long, n long, n_low long, n_toxic long").groupBy("f").agg(*[F.sum(c).alias(c) for c in ("n", "n_low", "n_toxic")]).where("n >= 5"), "features")
    keys = set()
    for t in usable:
        strength = _strength(F.col("n"), F.col(f"n_{TARGETS[t]}"), total, positive[t])
        keys |= {r["f"] for r in counts.orderBy(strength.desc(), "f").limit(n_features).select("f").collect()}
    model = Model(np.array(sorted(keys), dtype=np.int64).view(U64))
    if not usable:
        return model
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch in batches:
            for i, j, buf, offs in text_blocks(batch.column(0)):
                doc, f = sent.value.present(buf, offs)
                first = np.searchsorted(doc, np.arange(j - i + 1))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(f.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i), lists], names=["low", "toxic", "f"])

    table = texts.mapInArrow(tidied(rows), "low int, toxic int, f array<int>").toArrow()  # at most `sample` rows
    lists = table.column("f").combine_chunks()
    feature = np.asarray(lists.flatten(), dtype=np.int64)
    doc = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
    for t in usable:
        y = np.asarray(table.column(TARGETS[t]).combine_chunks(), dtype=np.float64)
        model.weights[t], model.bias[t] = _regress(doc, feature, len(model.lookup.keys), y)
    return model


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _pull(n: float, rate: float, spread: float, groups: float) -> float:
    """The strength of a prior in documents, from the spread of rates around it."""
    noise = rate * (1 - rate) * max(0.0, groups - 1) / max(1.0, n)
    between = spread / max(1.0, n) - noise
    return min(1e6, max(2.0, rate * (1 - rate) / max(between, 1e-9) - 1))


def site_rates(scores: DataFrame) -> tuple[DataFrame, dict]:
    """One row for each host and path with sums of both; and the global rates and strengths.

    scores: host, path, and p_<target> of each document.  The sums: hn and h_<target>
    of the host, pn and s_<target> of the path.
    """
    paths = materialize(scores.groupBy("host", "path").agg(F.count("*").alias("pn"), *[F.sum(f"p_{t}").alias(f"s_{t}") for t in TARGETS]), "paths")
    hosts = paths.groupBy("host").agg(F.sum("pn").alias("hn"), *[F.sum(f"s_{t}").alias(f"h_{t}") for t in TARGETS])
    whole = hosts.agg(F.sum("hn").alias("n"), F.count("*").alias("hosts"), *[F.sum(f"h_{t}").alias(t) for t in TARGETS]).first()
    n = float(whole["n"] or 0)
    about = {t: {"rate": (whole[t] or 0.0) / n if n else 0.0} for t in TARGETS}
    spread = hosts.agg(*[F.sum(F.col("hn") * F.pow(F.col(f"h_{t}") / F.col("hn") - F.lit(about[t]["rate"]), 2)).alias(t) for t in TARGETS]).first()
    for t in TARGETS:
        about[t]["host"] = _pull(n, about[t]["rate"], spread[t] or 0.0, whole["hosts"])
    sites = paths.join(hosts, "host")
    rate = {t: (F.lit(about[t]["host"] * about[t]["rate"]) + F.col(f"h_{t}")) / (F.lit(about[t]["host"]) + F.col("hn")) for t in TARGETS}
    spread = sites.agg(F.count("*").alias("paths"), *[F.sum(F.col("pn") * F.pow(F.col(f"s_{t}") / F.col("pn") - rate[t], 2)).alias(t) for t in TARGETS]).first()
    for t in TARGETS:
        about[t]["path"] = _pull(n, about[t]["rate"], spread[t] or 0.0, spread["paths"] - whole["hosts"] + 1)
    return sites, about


def posterior(z: Column, p: Column, site: Column, t: str, about: dict) -> Column:
    """The document's probability with its site's, its own part in the site left out.

    z, p: its own log odds and probability; site: a row of site_rates.
    """
    a = about[t]
    host = (F.lit(a["host"] * a["rate"]) + site[f"h_{t}"] - p) / (F.lit(a["host"]) + site["hn"] - 1)
    path = (F.lit(a["path"]) * host + F.greatest(site[f"s_{t}"] - p, F.lit(0.0))) / (F.lit(a["path"]) + site["pn"] - 1)
    return 1 / (1 + F.exp(-(z + _logit(path) - _logit(F.lit(a["rate"])))))


def judge(docs: DataFrame, labels: DataFrame, *, host_col: str = "source", path_col: str = "lang", sample: int = 10_000, n_features: int = 1000, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """docs and, as its last five columns, __host, __path, __low, __toxic (posterior probabilities) and __keep (or with further underscores, where docs has these).

    Each text is scored once: rows and scores are written, and read again for the
    sites' sums and for the judgement.  with_text=False: without the text column.
    """
    model = fit(docs, labels, sample=sample, n_features=n_features, id_col=id_col, text_col=text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # n_features a target at most
    host, path, *marks = fresh(docs, "__host", "__path", *[f"__{c}_{t}" for t in TARGETS for c in "zp"])

    def score(texts: pa.Array):
        z = sent.value.evidence(texts)
        return [pa.array(x) for pair in zip(z, 1 / (1 + np.exp(-np.clip(z, -30, 30))), strict=True) for x in pair]

    text_of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    sited = docs.withColumns({host: text_of(host_col), path: text_of(path_col)})
    scored = add_columns(sited, score, [text_col], ", ".join(f"`{m}` double" for m in marks))
    kept = [c for c in docs.columns if with_text or c != text_col]
    scored = materialize(scored.select(*[F.col(f"`{c}`") for c in (*kept, host, path, *marks)]), "scored")
    p_of = dict(zip(TARGETS, marks[1::2], strict=True))
    sites, about = site_rates(scored.select(F.col(host).alias("host"), F.col(path).alias("path"), *[F.col(m).alias(f"p_{t}") for t, m in p_of.items()]))
    (site,) = fresh(scored, "__site")
    # A written table: where it is small, its known size makes the join a broadcast, and no text is shuffled.
    sites = materialize(sites.select(F.struct("*").alias(site)), "sites")
    joined = scored.join(sites, (F.col(host) == F.col(f"{site}.host")) & (F.col(path) == F.col(f"{site}.path")))
    names = dict(zip(("host", "path", *TARGETS, "keep"), (host, path, *fresh(scored, *[f"__{t}" for t in TARGETS], "__keep")), strict=True))
    judged = joined.withColumns({names[t]: posterior(F.col(marks[2 * k]), F.col(marks[2 * k + 1]), F.col(site), t, about) for k, t in enumerate(TARGETS)})
    keep = (F.col(names["low"]) < threshold) & (F.col(names["toxic"]) < threshold)
    return judged.select(*[F.col(f"`{c}`") for c in (*kept, host, path)], names["low"], names["toxic"], keep.alias(names["keep"]))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns."""
    judged = judge(docs, labels, **options)
    return judged.where(judged.columns[-1]).select(*[F.col(f"`{c}`") for c in docs.columns])
