import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerspark.llm import pfor

CASES = [[], [0], [5] * 3000, list(range(5000)), [2**32 - 1, 0] * 700, [1] * 1023 + [2**31], [7] * 1024]


@pytest.mark.parametrize("ids", CASES, ids=range(len(CASES)))
def test_round_trip(ids):
    data = pfor.pack(np.array(ids, np.uint32))
    assert pfor.unpack(data).tolist() == ids
    assert pfor.unpack(data, 3, 1500).tolist() == ids[3:1500]


def test_random_round_trip_and_size():
    rng = np.random.default_rng(1)
    for high in (2, 300, 50_000, 2**32):
        ids = np.where(rng.random(10_000) < 0.97, rng.integers(0, high, 10_000), rng.integers(0, 2**32, 10_000)).astype(np.uint32)
        data = pfor.pack(ids)
        assert (pfor.unpack(data) == ids).all()
    assert len(pfor.pack(rng.integers(0, 50_000, 10_000))) < 2.1 * 10_000


def brute(rows):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    out, start = [], 0
    for d, t in sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0], r[1])):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_written_and_read(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "two  blanks \n here "), (-3, "two  blanks \n here "), (-4, "<|endoftext|> it's"),
         (None, "no id"), (10**12, "long word " * 20_000), (-5, "a b  c")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    got = sorted((tuple(r) for r in pfor.written_and_read(docs).collect()), key=lambda r: r[1])
    assert got == brute([tuple(r) for r in docs.collect()])


def test_documents_from_files(spark, tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        content = f.read()
    docs = spark.createDataFrame([(2, "b c"), (1, "a")], "doc_id long, text string")
    pfor.write(docs, str(tmp_path / "t"), content, end_id=9)
    rows = sorted(map(tuple, pfor.documents(pfor.read(spark, str(tmp_path / "t"))).collect()))
    assert [r[0] for r in rows] == [1, 2] and rows[0][1] == 0 and rows[1][1] == len(rows[0][2])
    assert all(r[2][-1] == 9 for r in rows)


def test_empty_table(spark):
    assert pfor.written_and_read(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registered_query_equals_the_plain_library(spark, tmp_path):
    from ledgerspark.llm.queries import op3_token_blocks

    texts = ["end <|endoftext|> begin", "a<|endoftext|>b, c", "two  <|endoftext|>  x", "<|endoftext|>, <|endoftext|>", "plain, text", "\n<|endoftext|>\n a"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    tok, want, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), [], 0
    for d, t in enumerate(texts):
        ids = [*tok.encode(t, add_special_tokens=False).ids, pfor.END_ID]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in op3_token_blocks(spark, str(tmp_path)).collect()) == want


def test_common_words_skip_the_bookkeeping_of_whole_texts():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        content = f.read()
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é'll" + end for i in range(500) for end in ("", ".\nNext", "$$$", "2,x²")]
    words += ["naïve", "ªº", "×÷", "a\u00adb", "it's", "'s", "I'LL", "ab\n\n", "\n\nab", "a\u0085b", "a\u00a0b", "ɐb", "日本", "a\x1cb", "<|endoftext|>"]
    tok = Tokenizer.from_str(content)
    for as_text in (True, False):
        own = pfor.Encoder(content, as_text=as_text)._set_up()
        whole, plain = [], own._ids
        own._ids = lambda texts: whole.extend(texts) or plain(texts)
        texts = ["first " + " ".join(words[i:i + 50]) for i in range(0, len(words), 50)]
        ids, counts = own.encode(texts)
        tok.encode_special_tokens = as_text
        want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
        assert len(whole) < len(texts) + 10  # beginnings of texts, and a few uncommon words
