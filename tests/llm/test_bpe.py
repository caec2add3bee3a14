import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from ledgerspark.llm import bpe
from ledgerspark.llm.common import WordPool

TEXTS = ["", " ", "a", "Hello  world", "a \n b\t\tc   d ", "don't stop!! 123 4567", "naïve Ωmega 日本語 🙂🙂",
         "x" * 3000, "  leading", "tab\tand nbsp  em", "\x1c\x1d odd \x85 blanks", " ".join("word%d" % i for i in range(300)),
         "a" * 200 + " " + "ab" * 500, "\r\n\r\n end \n"]


@pytest.fixture(scope="module")
def codec():
    return bpe.default_codec().ready()


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(codec):
    assert sorted(codec.hash.slots) == list(range(codec.hash.n))
    assert all(codec.hash.index(v) == i for i, v in enumerate(codec.vocabulary))


def test_small_perfect_hashes():
    for n in (1, 2, 3, 10, 100):
        keys = [b"k%d" % i for i in range(n)]
        h = bpe.PerfectHash(keys)
        assert [h.index(k) for k in keys] == list(range(n))


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_bytes(codec, reference, text):
    ids = codec.encode(text)
    assert ids.tolist() == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_pool_stays_bounded_and_right():
    seen = []
    pool = WordPool(lambda words: [seen.extend(words) or tuple(map(ord, w)) for w in words], {".": 46}, 10)
    for i in range(60):
        words = [f"w{(i * k) % 37}" + "." * (k % 2) for k in range(1, 5)]
        texts = [" ".join(["x", *words]), "whole  text", "", "y"]
        out, counts = pool.of_texts(texts, [False, True, False, False], lambda own: [tuple(map(ord, w)) for w in own])
        want = [("x" + "".join(words)), "whole  text", "", "y"]
        assert "".join(map(chr, out)) == "".join(want) and counts.tolist() == list(map(len, want))
        assert len(pool.known) <= 16
    assert not any(w.endswith(".") for w in seen)


def test_digests(spark, sf_dir, codec, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, TEXTS[4]), (-3, TEXTS[4])], "doc_id long, text string")
    docs = docs.unionByName(odd)
    got = sorted(map(tuple, bpe.digests(docs, codec).collect()))
    want = []
    for r in docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_clashing_columns_and_empty_table(spark, codec):
    t = spark.createDataFrame([("a b", "old", 1.5)], "text string, ids string, decoded double")
    row = bpe.decode(bpe.encode(t, codec), codec).collect()[0]
    assert bytes(row.decoded) == b"a b" and len(row.ids) == 2
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), codec).count() == 0
