"""Token ids in patched frame-of-reference blocks, written by Spark and read back.

File format: a Parquet table ``segments`` under the given folder, one row per segment of
whole documents in ascending doc_id order: ``shard`` (partition of the order), ``segment``
(place in the shard), ``first`` (ids of the shard before it), ``n`` (its ids), ``doc_ids``
and ``counts`` (int64, little-endian: the documents and how many ids each has) and ``data``.  ``data`` is, all little-endian:

    uint32 number of ids, uint32 number of blocks
    uint32 per block: where its body starts, counted from the start of ``data``
    a body per block of ``BLOCK`` ids (the last one may be shorter):
        uint32 minimum, uint8 width, uint16 exceptions
        (id - minimum) mod 2^width in ``width`` bits each, lowest bit first, to a whole byte
        uint16 per exception: its place; uint32 per exception: (id - minimum) >> width

The width is the number of bits of the ``PERCENTILE``-th of the block's differences in
rising order, so that few ids are exceptions.

Documents are put in order by range partitioning, so a shard's first id in the whole
sequence is the sum over earlier shards: one number per shard is summed.  Lengths only
decide where a segment is closed; a document is never cut, and memory is bounded by a
segment plus the longest document.

Defined cases: a null text is an empty one and has the end id only; rows with the same
doc_id stand next to each other in the order of their texts (null as empty); an empty
table has no segments.  A null doc_id comes first.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm.bpe import REMEMBERED, split_later
from ledgerspark.llm.common import WordPool, in_groups, join_small, keep, released
from ledgerspark.sources.scratch import scratch_path

BLOCK = 1024
SEGMENT_IDS = 65_536
PERCENTILE = 95
END_ID = 0
GROUP_CHARACTERS = 2_000_000  # encoded at a time
PIECE_ROWS = 600  # of a batch, handled at a time
ENCODED_AT_ONCE = 10_000
NO_DOC = -(2**63)  # stands for a null doc_id

_SCHEMA = "shard int, segment int, first long, doc_ids binary, counts binary, n long, data binary"


def bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def pack(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """The bytes of one segment; ids are below 2^32."""
    ids = np.asarray(ids, np.uint32)
    bodies = []
    for at in range(0, len(ids), block):
        part = ids[at:at + block]
        low = part.min()
        diff = part - low
        k = -(-len(diff) * PERCENTILE // 100) - 1
        width = int(bit_lengths(np.partition(diff, k)[k:k + 1])[0])
        over = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
        whole = diff.astype("<u2" if width <= 16 else "<u4")  # bits above the width go to the exceptions
        bits = np.unpackbits(whole.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")[:, :width]
        high = diff[over] >> np.uint32(width) if len(over) else np.zeros(0, np.uint32)
        bodies.append(low.astype("<u4").tobytes() + bytes([width]) + len(over).to_bytes(2, "little")
                      + np.packbits(bits, bitorder="little").tobytes()
                      + over.astype("<u2").tobytes() + high.astype("<u4").tobytes())
    starts = 8 + 4 * len(bodies) + np.cumsum([0, *map(len, bodies)])[:-1]
    return np.array([len(ids), len(bodies)], "<u4").tobytes() + starts.astype("<u4").tobytes() + b"".join(bodies)


def unpack(data: bytes, first: int = 0, last: int | None = None, block: int = BLOCK) -> np.ndarray:
    """Ids ``first`` to ``last`` of a segment; only the blocks that hold them are read."""
    n, blocks = np.frombuffer(data, "<u4", 2).tolist()
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(data, "<u4", blocks, 8).tolist()
    out = []
    for b in range(first // block, (last - 1) // block + 1):
        at, size = starts[b], min(block, n - b * block)
        low = np.frombuffer(data, "<u4", 1, at)[0]
        width, over = data[at + 4], int.from_bytes(data[at + 5:at + 7], "little")
        packed = np.frombuffer(data, np.uint8, -(-size * width // 8), at + 7)
        bits = np.unpackbits(packed, bitorder="little", count=size * width).reshape(size, width)
        wide = np.zeros((size, 32), np.uint8)
        wide[:, :width] = bits
        diff = np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1).copy()
        at += 7 + len(packed)
        place = np.frombuffer(data, "<u2", over, at)
        diff[place] |= np.frombuffer(data, "<u4", over, at + 2 * over) << np.uint32(width % 32)
        out.append(diff + low)
    whole = np.concatenate(out)
    return whole[first - first // block * block:][:last - first]


# Characters whose kind (letter, digit, blank) is the same in every version of Unicode in use, and the byte-level cut.
_COMMON_UP_TO = "\u0250"
_COMMON = regex.compile("[\n!-~\u00a1-\u024f]+")
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The byte-level alphabet: a printable byte stands for itself, each other byte for the next code point from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}
_ALPHABET = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(0x250)}
_SPACE = _ALPHABET[32]


def _byte_level(file: dict) -> bool:
    """Whether a tokenizer file cuts texts by the byte-level rule and does nothing else before its merges."""
    cut = file.get("pre_tokenizer") or {}
    return (file.get("normalizer") is None and file.get("truncation") is None and file.get("padding") is None
            and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            and not any(t["content"].strip().isalpha() for t in file.get("added_tokens") or []))


_held: dict[str, Encoder] = {}


class Encoder:
    """Words to ids with a tokenizer file's content; words met are remembered up to a bound.

    ``as_text``: a special token's literal in a text is plain text, and not that token.
    """

    def __init__(self, content: str, remembered: int = REMEMBERED, as_text: bool = True):
        self.content, self.remembered, self.as_text = content, remembered, as_text

    def __getstate__(self):
        return self.content, self.remembered, self.as_text

    def __setstate__(self, state):
        self.content, self.remembered, self.as_text = state

    def ready(self) -> Encoder:
        """This encoder with its memory: one in a worker, however many jobs it serves."""
        held = _held.get("encoder")
        if held is None or held.__getstate__() != self.__getstate__():
            _held["encoder"] = held = self
        return held._set_up()

    def _set_up(self) -> Encoder:
        if not hasattr(self, "words"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.content)
            self.tokenizer.encode_special_tokens = self.as_text
            file = json.loads(self.content)
            self.added = regex.compile("|".join(regex.escape(t["content"].strip()) for t in file.get("added_tokens") or []) or "(?!)")
            self.merged = self.tokenizer.model.tokenize if _byte_level(file) else None
            self.words = WordPool(self._words, {m: i for m, (i,) in zip(",.", self._ids([",", "."]))}, self.remembered)
        return self

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all whole texts in order, and how many each has.

        The byte-level cut begins a piece at every space before a non-blank, so distinct words
        are encoded once each; texts with longer runs of blanks are encoded whole.
        """
        return self.words.of_texts(texts, split_later(texts), self._ids)

    def _words(self, words: list[str]) -> list[list[int]]:
        """The ids of words, each after a space.

        Words of common characters are cut here, by the file's own rule, and the library's model is
        given piece by piece, which spares it the bookkeeping of a whole text around each word.
        """
        if self.merged is None:
            return self._ids([" " + w for w in words])
        merged, out, others = self.merged, [], []
        for w in words:
            if w.isalpha() and (w.isascii() or max(w) < _COMMON_UP_TO):  # one piece with its space
                out.append([t.id for t in merged(_SPACE + (w if w.isascii() else w.translate(_ALPHABET)))])
            elif _COMMON.fullmatch(w) and not self.added.search(w):
                out.append([t.id for p in _CUT.findall(" " + w) for t in merged(p.translate(_ALPHABET))])
            else:
                others.append(len(out))
                out.append([])
        for i, ids in zip(others, self._ids([" " + words[i] for i in others])):
            out[i] = ids
        return out

    def _ids(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for at in range(0, len(texts), ENCODED_AT_ONCE):  # what the library returns is much larger than the ids
            part = texts[at:at + ENCODED_AT_ONCE]
            out += [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out


def write(docs: DataFrame, folder: str, content: str, end_id: int = END_ID, as_text: bool = True) -> None:
    """Encode ``doc_id``, ``text`` with a tokenizer file's content and write the segments."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Encoder(content, as_text=as_text))

    def coded(own: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
        for at in range(0, batch.num_rows, PIECE_ROWS):
            part = batch.slice(at, PIECE_ROWS)
            docs = iter(part.column("doc_id").to_pylist())
            for texts in in_groups([t or "" for t in part.column("text").to_pylist()], GROUP_CHARACTERS):
                all_ids, counts = own.encode(texts)
                parts = np.split(all_ids.astype(np.uint32), np.cumsum(counts)[:-1])
                yield from zip(itertools.islice(docs, len(parts)), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.ready()
        end = np.array([end_id], np.uint32)
        ids: list[np.ndarray] = []
        who: list[int] = []
        state = {"shard": 0, "segment": 0, "first": 0}

        def close() -> pa.RecordBatch:
            all_ids = np.concatenate(ids)
            row = [[state["shard"]], [state["segment"]], [state["first"]], [np.array(who, "<i8").tobytes()],
                   [np.array([len(x) for x in ids], "<i8").tobytes()], [len(all_ids)], [pack(all_ids)]]
            state["segment"] += 1
            state["first"] += len(all_ids)
            ids.clear()
            who.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()))],
                ["shard", "segment", "first", "doc_ids", "counts", "n", "data"])

        held = 0
        for batch in released(batches):
            if not batch.num_rows:
                continue
            state["shard"] = batch.column("shard")[0].as_py()
            for d, x in coded(own, batch):
                ids.append(np.concatenate([x, end]))
                who.append(NO_DOC if d is None else d)
                held += len(ids[-1])
                if held >= SEGMENT_IDS:
                    yield close()
                    held = 0
        if ids:
            yield close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.coalesce("text", F.lit("")))
    ordered = ordered.withColumn("shard", F.spark_partition_id())
    ordered.mapInArrow(run, _SCHEMA).write.parquet(f"{folder}/segments")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start``: how many ids come before the segment in the whole sequence."""
    t = spark.read.parquet(f"{folder}/segments")
    sizes = t.groupBy("shard").agg(F.sum("n").alias("size"))  # one row per shard
    before = F.sum("size").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    firsts = keep(sizes.select("shard", F.coalesce(before, F.lit(0)).alias("_before")), "shards")
    return join_small(t, firsts, "shard", "inner").withColumn("start", F.col("_before") + F.col("first"))


def documents(segments: DataFrame) -> DataFrame:
    """doc_id, start and ids of every document, unpacked from the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, first, counts, ids in _unpacked(batches):
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([d, pa.array(first), lists], ["doc_id", "start", "ids"])

    return segments.select("doc_ids", "counts", "start", "data").mapInArrow(run, "doc_id long, start long, ids array<long>")


def _unpacked(batches: Iterator[pa.RecordBatch]):
    for batch in released(batches):
        for row in batch.to_pylist():
            d = np.frombuffer(row["doc_ids"], "<i8")
            counts = np.frombuffer(row["counts"], "<i8")
            first = row["start"] + np.cumsum(counts) - counts
            yield pa.array(d, mask=d == NO_DOC), first, counts, unpack(row["data"])


def checksums(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the unpacked ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, first, counts, ids in _unpacked(batches):
            raw, ends = memoryview(ids.astype("<u4").tobytes()), 4 * np.cumsum(counts)
            crc = [zlib.crc32(raw[e - 4 * c:e]) for e, c in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays([d, pa.array(first), pa.array(counts), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("doc_ids", "counts", "start", "data").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(docs: DataFrame, path: str | None = None, folder: str | None = None, as_text: bool = True) -> DataFrame:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        content = f.read()
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    write(docs, folder, content, as_text=as_text)
    return checksums(read(spark, folder))
