import base64
import hashlib
import random
import string

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from wattloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
HARD = ["", " ", "\n\n", "\r\n x", "don't 'LL they'll", "a" * 900, "ab" * 3000, "  two   spaces ", " x y\u0085z", "日本語 テスト", "éé", "\U0001f600\U0001f468‍\U0001f469", "x\x00y\x1cz", "<|endoftext|>", "1234 ½ Ⅷ ٣", "ſ ß İ ǅ", "�￾", "tab\tand\x0bmore\x0c", " ×÷ ", "'s's 't"]


def _encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    random.seed(12)
    alphabet = string.ascii_letters + string.digits + string.punctuation + " \n\t\r éÉß日本́‍½"
    rows = HARD + ["".join(random.choices(alphabet, k=random.randrange(1, 300))) for _ in range(150)]
    rows += [" ".join("".join(random.choices("aeinorst", k=random.randrange(1, 12))) for _ in range(80)) for _ in range(40)]
    return rows + ["long text, " * 60_000]


def test_ids_equal_the_librarys_and_decode_to_the_text(spark):
    texts = [*_texts(), None]
    docs = spark.createDataFrame([(k % 90, t, 1, "y") for k, t in enumerate(texts)], "doc_id long, text string, IDS int, `de.coded` string").repartition(3)
    rows = bpe.decode(bpe.encode(docs, ranks=PATH, pattern=public_tokenizers.PATTERN), ranks=PATH).collect()
    library = _encoding(bpe.read_ranks(PATH))
    assert sorted((r["text"] or "", r["doc_id"]) for r in rows) == sorted((t or "", k % 90) for k, t in enumerate(texts))
    for r in rows:
        assert r["ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode() and r["de.coded"] == "y"


def test_query_against_the_library(spark, tmp_path):
    texts = [*_texts(), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    library = _encoding(bpe.read_ranks(PATH))
    got = queries.op12_byte_bpe(spark, str(tmp_path)).collect()
    want = []
    for k, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got)) == want


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, ranks=PATH, pattern=public_tokenizers.PATTERN), ranks=PATH).count() == 0
    rows = bpe.decode(spark.createDataFrame([(None,), ([],), ([15496, 995],)], "ids array<int>"), ranks=PATH).collect()
    assert [None if r["decoded"] is None else bytes(r["decoded"]) for r in rows] == [None, b"", b"Hello world"]
    with pytest.raises(ValueError, match="not in the vocabulary"):
        bpe.Decoder(PATH).column(pa.array([[50256]], pa.list_(pa.int32())))


def test_ranks_that_do_not_rise_with_length(tmp_path):
    """A long token with a small rank, so that the order of contractions matters; whole words that no merge reaches."""
    random.seed(5)
    made = [bytes([b]) for b in range(256)] + [b"ab", b"abab", b"bab", b"ba", b"aba", b"xyz", b"cab", b"bc", b"abc", b"aab"]
    order = list(range(256, 256 + len(made) - 256))
    for trial in range(6):
        random.shuffle(order)
        ranks = dict(zip(made, [*range(256), *order], strict=True))
        path = f"{tmp_path}/{trial}.tiktoken"
        with open(path, "wb") as f:
            f.writelines(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items())
        texts = ["".join(random.choices("abc", k=random.randrange(1, 40))) for _ in range(200)] + ["xyz", "axyz", "ab" * 50]
        encoder, library = bpe.RankEncoder(path, public_tokenizers.PATTERN), _encoding(ranks)
        words = [t.encode() for t in texts]
        flat, counts = encoder.contracted(words)
        ends = counts.cumsum()
        for k, w in enumerate(words):
            one = flat[ends[k] - counts[k] : ends[k]].tolist()
            assert one == encoder._heaped(w) and (w in ranks or one == library.encode_ordinary(texts[k]))
        got = [encoder._encode([t])[0].tolist() for t in texts]
        assert got == [library.encode_ordinary(t) for t in texts]
