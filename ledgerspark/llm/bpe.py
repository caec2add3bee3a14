"""Byte-level BPE: whole pre-tokens through a minimal perfect hash, the rest by merging.

A text is cut by the public pattern.  A pre-token that is a vocabulary entry gets its id
from the minimal perfect hash; any other one is merged from its bytes: a heap holds the
rank of every neighbouring pair, the parts are linked, and the lowest rank (leftmost on
ties) is merged until no pair is a vocabulary entry.

The vocabulary is read once on the driver and broadcast (its size is the file's, some
50,000 entries).  Each worker remembers the ids of words that it met, up to ``REMEMBERED`` bytes,
so its memory is bounded whatever the corpus holds.  ``token_ids``, a stage among others, keeps
``REMEMBERED_IN_STAGE`` bytes at most, and only until its task ends.

Defined cases: a null text is an empty one and has no ids; a text of any length is
encoded whole; extra columns are carried along, columns named like the results are
replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import WordPool, in_groups, released

REMEMBERED = 128 << 20
REMEMBERED_IN_STAGE = 24 << 20
_PRIME = 2**31 - 1
DECODED_IDS = 500_000  # decoded at a time
GROUP_CHARACTERS = 2_000_000  # encoded at a time
PIECE_ROWS = 600  # of a batch, handled at a time

# Fixed value: the characters of the White_Space property, as the pattern's \s means them.
_BLANK = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT_LATER = f" [{_BLANK.encode().decode('unicode_escape')}]"


def split_later(texts: list[str]) -> list[bool]:
    """Whether a text has a run of blanks in which a pre-token does not begin at the first space."""
    return pc.match_substring_regex(pa.array(texts, pa.string()), _SPLIT_LATER).to_pylist()


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file in the order of their ids."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("The ranks are not 0, 1, 2, ...")
    return [ranks[i] for i in range(len(ranks))]


def blanks_spelled_out(pattern: str) -> str:
    return pattern.replace(r"[^\s", f"[^{_BLANK}").replace(r"\S", f"[^{_BLANK}]").replace(r"\s", f"[{_BLANK}]")


class PerfectHash:
    """Keys to 0..n-1 without gaps: a displacement per bucket, a slot itself for lone keys.

    Anything else lands on some slot too, so the key kept there is compared.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 3):
        self.n, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        self.shift = np.zeros(self.buckets, np.int64)
        self.slots: list[int] = [-1] * self.n
        members: dict[int, list[int]] = {}
        parts = [self._parts(k) for k in keys]
        for i, (b, _, _) in enumerate(parts):
            members.setdefault(b, []).append(i)
        taken = np.zeros(self.n, bool)
        free = None
        for b in sorted(members, key=lambda b: (-len(members[b]), b)):
            own = members[b]
            if len(own) == 1:
                free = free or iter(np.flatnonzero(~taken).tolist())
                slot = next(free)
                self.shift[b] = -slot - 1
                self.slots[slot] = own[0]
                continue
            first = np.array([parts[i][1] for i in own])[:, None]
            step = np.array([parts[i][2] for i in own])[:, None]
            at = 0
            while True:
                d = np.arange(at, at + 512)
                slots = (first + d * step) % _PRIME % self.n
                fits = ~taken[slots].any(0)
                for k in np.flatnonzero(fits):
                    if len(set(slots[:, k].tolist())) == len(own):
                        break
                else:
                    at += 512
                    if at > 2**24:
                        raise ValueError("Two keys have the same hash")
                    continue
                self.shift[b] = at + k
                taken[slots[:, k]] = True
                for i, s in zip(own, slots[:, k].tolist()):
                    self.slots[s] = i
                break
        self.shift = self.shift.tolist()

    def _parts(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return (h & 0xFFFFFFFF) % self.buckets, (h >> 32) % _PRIME, (h >> 64) % (_PRIME - 1) + 1

    def index(self, key: bytes) -> int:
        """The place in the key list that this key has, if it is a key at all."""
        b, first, step = self._parts(key)
        d = self.shift[b]
        return self.slots[-d - 1 if d < 0 else (first + d * step) % _PRIME % self.n]


_held: dict[str, Codec] = {}


class Codec:
    """Encodes and decodes with one vocabulary, given in the order of the ids."""

    def __init__(self, vocabulary: list[bytes], pattern: str, remembered: int = REMEMBERED):
        self.vocabulary, self.pattern, self.remembered = vocabulary, pattern, remembered
        self.hash = PerfectHash(vocabulary)
        self.key = xxhash.xxh3_128_hexdigest(repr((pattern, remembered, vocabulary)).encode())

    def __getstate__(self):
        return self.vocabulary, self.pattern, self.remembered, self.hash, self.key

    def __setstate__(self, state):
        self.vocabulary, self.pattern, self.remembered, self.hash, self.key = state

    def ready(self) -> Codec:
        """This codec, compiled and with memory: one in a worker, however many jobs it serves."""
        held = _held.get("codec")
        if held is None or held.key != self.key:
            _held["codec"] = held = self
        return held._set_up()

    def _set_up(self) -> Codec:
        if not hasattr(self, "cut"):
            self.cut = regex.compile(blanks_spelled_out(self.pattern))
            self.ranks = {v: i for i, v in enumerate(self.vocabulary)}
            self.sizes = [len(v) for v in self.vocabulary]
            self.longest = max(self.sizes, default=0)
            self.pairs = [self.ranks.get(bytes((a, b))) for a in range(256) for b in range(256)]
            marks = {m: self.pre_token(m.encode())[0] for m in ",." if len(self.pre_token(m.encode())) == 1}
            self.words = WordPool(lambda words: [self._word(" " + w) for w in words], marks, self.remembered)
            self.lengths = np.array([len(v) for v in self.vocabulary], np.int64)
            self.begins = np.cumsum(self.lengths) - self.lengths
            self.bytes = np.frombuffer(b"".join(self.vocabulary), np.uint8)
        return self

    def _word(self, text: str) -> tuple[int, ...]:
        return tuple(itertools.chain.from_iterable(self.pre_token(m.encode()) for m in self.cut.findall(text)))

    def pre_token(self, token: bytes) -> tuple[int, ...]:
        if len(token) <= self.longest:
            i = self.hash.index(token)
            if self.vocabulary[i] == token:
                return (i,)
        return self.merged(token)

    def merged(self, token: bytes) -> tuple[int, ...]:
        """Merge by rank: a heap of pairs over linked parts."""
        n = len(token)
        ends = list(range(1, n + 1))  # where the part that begins here ends; 0: no longer a part
        before = list(range(-1, n - 1))
        rank_of, pairs, push, pop = self.ranks.get, self.pairs, heapq.heappush, heapq.heappop
        heap = [(r, i) for i, (a, b) in enumerate(zip(token, token[1:])) if (r := pairs[a << 8 | b]) is not None]
        heapq.heapify(heap)
        size = self.sizes
        while heap:
            rank, i = pop(heap)
            middle, end = ends[i], i + size[rank]
            if not middle or middle >= end or ends[middle] != end:
                continue  # one of the two parts has changed
            ends[middle], ends[i] = 0, end
            if end < n:
                before[end] = i
                if (r := rank_of(token[i:ends[end]])) is not None:
                    push(heap, (r, i))
            if (p := before[i]) >= 0 and (r := rank_of(token[p:end])) is not None:
                push(heap, (r, p))
        ranks, out, i = self.ranks, [], 0
        while i < n:
            end = ends[i]
            out.append(ranks[token[i:end]])
            i = end
        return tuple(out)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all whole texts in order, and how many each has.

        Where a space stands before a non-blank a pre-token begins, so words are looked up
        one by one; a text with a longer run of blanks is cut by the pattern as a whole.
        """
        return self.words.of_texts(texts, split_later(texts), lambda own: map(self._word, own))

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        at = np.arange(int(lengths.sum())) + np.repeat(self.begins[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.bytes[at].tobytes()


def _encoded(codec: Codec, texts: pa.Array) -> pa.ListArray:
    ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for group in in_groups([t or "" for t in texts.to_pylist()], GROUP_CHARACTERS):
        i, n = codec.encode_all(group)
        ids.append(i.astype(np.int32))
        counts.append(n)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))


def _decoded(codec: Codec, ids: pa.ListArray) -> pa.Array:
    result = []
    for row in ids:
        v = np.zeros(0, np.int32) if row.values is None else row.values.to_numpy(zero_copy_only=False)
        result.append(b"".join(codec.decode(v[i:i + DECODED_IDS]) for i in range(0, len(v), DECODED_IDS)))
    return pa.array(result, pa.binary())


_IDS, _BYTES = T.ArrayType(T.IntegerType()), T.BinaryType()


def _with_columns(df: DataFrame, codec: Codec, added, forget: bool = False) -> DataFrame:
    """The frame with columns made by the codec, one after the other: (name, type, from, how).

    With ``forget`` a task leaves no remembered words in its worker.
    """
    shared = df.sparkSession.sparkContext.broadcast(codec)
    df = df.drop(*(name for name, *_ in added))
    schema = T.StructType([*df.schema.fields, *(T.StructField(name, kind) for name, kind, _, _ in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for at in range(0, batch.num_rows, PIECE_ROWS):
                part = batch.slice(at, PIECE_ROWS)
                columns = dict(zip(part.schema.names, part.columns))
                for name, _, source, how in added:
                    columns[name] = how(shared.value.ready(), columns[source])
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        if forget:
            shared.value.ready().words.clear()

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, codec: Codec, text: str = "text", out: str = "ids") -> DataFrame:
    """The frame with the ids of each whole text, as an array of int."""
    return _with_columns(df, codec, [(out, _IDS, text, _encoded)])


def decode(df: DataFrame, codec: Codec, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with the bytes that each array of ids stands for; null ids give no bytes."""
    return _with_columns(df, codec, [(out, _BYTES, ids, _decoded)])


def encode_decode(df: DataFrame, codec: Codec, text: str = "text", forget: bool = False) -> DataFrame:
    """The frame with ``ids`` of each whole text, and ``decoded`` made from these ids."""
    return _with_columns(df, codec, [("ids", _IDS, text, _encoded), ("decoded", _BYTES, "ids", _decoded)], forget)


def default_codec(path: str | None = None, remembered: int = REMEMBERED) -> Codec:
    import public_tokenizers

    return Codec(read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN,
                 remembered)


def digests(docs: DataFrame, codec: Codec | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    codec = codec or default_codec()
    both = encode_decode(docs.select("doc_id", "text"), codec)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def token_ids(docs: DataFrame, codec: Codec | None = None) -> DataFrame:
    """doc_id, source, n_tokens, ids of every whole text, and whether they decode to it."""
    own = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    coded = encode_decode(own, codec or default_codec(remembered=REMEMBERED_IN_STAGE), forget=True)
    same = F.col("decoded") == F.col("text").cast("binary")
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))
