"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token that a valid encoding of that
prefix can end with. Storing it for each prefix gives the encoding of any prefix by walking back,
lets bytes be appended without looking at earlier ones again, and after an edit only as
many positions are computed anew as it takes for the stored tokens to agree again.

A token may follow another one if replaying the merges of both never merges across their border
first. Merges follow the ranks alone, the leftmost of equal ranks first.

Defined results: a null text is encoded like an empty one, to no tokens. Each row is encoded by
itself, so repeated rows get equal results; an empty table gives an empty one. Texts are taken whole.
``encode`` returns the input's columns unchanged, whatever they are called, and one struct column.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tradewind.llm.common import giving_back, quoted, table

INFINITE = 1 << 62
#: Pieces whose encodings a Python worker keeps, and as many that were used before them.
CACHED_PIECES = 150_000
CACHED_PAIRS = 250_000
#: Rows that are handed over at once.
BATCH_CHARS = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def pack(*ids: int) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Vocabulary:
    """Token ranks with what the compatibility of two tokens needs, found when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        #: Ends of tokens; true for whole tokens.
        self.ends = {t[-n:]: False for t in ranks for n in range(1, len(t))}
        self.ends.update(dict.fromkeys(ranks, True))
        self._right: dict[bytes, list[tuple[bytes, int]]] = {}
        self._left: dict[bytes, list[tuple[bytes, int]]] = {}
        self._single: dict[bytes, bool] = {}
        #: What is known of the tokens that may follow a token.
        self.after: defaultdict[bytes, dict[bytes, bool]] = defaultdict(dict)
        self._n_pairs = 0

    def _merge(self, token: bytes) -> None:
        """Merge a token's bytes; keep what stood at either edge, and when it was merged on."""
        ranks, parts = self.ranks, [token[i : i + 1] for i in range(len(token))]
        right, left = [], []
        while len(parts) > 1:
            best, at = min(
                (ranks.get(x + y, INFINITE), i) for i, (x, y) in enumerate(pairwise(parts))
            )
            if best == INFINITE:
                break
            if at == len(parts) - 2:
                right.append((parts[-1], best))
            if at == 0:
                left.append((parts[0], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        self._single[token] = len(parts) == 1
        self._right[token] = [*right, (parts[-1], INFINITE)]
        self._left[token] = [*left, (parts[0], INFINITE)]

    def single(self, token: bytes) -> bool:
        """Whether the merges turn a token's bytes into this one token."""
        known = self._single.get(token)
        if known is None:
            self._merge(token)
            known = self._single[token]
        return known

    def learn(self, a: bytes, b: bytes) -> bool:
        """Find out, and keep, whether token ``b`` may follow token ``a``."""
        if self._n_pairs >= CACHED_PAIRS:
            self.after.clear()
            self._n_pairs = 0
        known = self.after[a][b] = self._replay(a, b)
        self._n_pairs += 1
        return known

    def _replay(self, a: bytes, b: bytes) -> bool:
        if not self.single(b):
            return False
        if not a:
            return True
        self.single(a)
        right, left, i, j = self._right[a], self._left[b], 0, 0
        while True:
            (x, x_until), (y, y_until) = right[i], left[j]
            across = self.ranks.get(x + y, INFINITE)
            if across < x_until and across <= y_until and across < INFINITE:
                return False
            if x_until == INFINITE and y_until == INFINITE:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1


class Prefixes:
    """The last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [b""]
        self.append(data)

    def _token_before(self, data: bytes, end: int, last: list[bytes]) -> bytes:
        """The token that an encoding of ``data[:end]`` ends with."""
        vocabulary = self.vocabulary
        ends, after = vocabulary.ends, vocabulary.after
        for start in range(end - 1, -1, -1):
            token = data[start:end]
            whole = ends.get(token)
            if whole:
                fits = after[last[start]].get(token)
                if fits is None:
                    fits = vocabulary.learn(last[start], token)
                if fits:
                    return token
            elif whole is None:
                break
        raise ValueError(f"no token ends at byte {end}; single bytes must be tokens")

    def append(self, more: bytes) -> None:
        """Extend by some bytes; nothing before them is looked at again."""
        start = len(self.data)
        data, last = self.data + more, self.last
        for end in range(start + 1, len(data) + 1):
            last.append(self._token_before(data, end, last))
        self.data = data

    def truncate(self, size: int) -> None:
        self.data = self.data[:size]
        del self.last[size + 1 :]

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of a range; returns how many positions were computed again."""
        data = self.data[:start] + new + self.data[end:]
        old, shift, last = self.last, len(new) - (end - start), self.last[: start + 1]
        agreed = 0
        for at in range(start + 1, len(data) + 1):
            last.append(self._token_before(data, at, last))
            # Once as many tokens as the longest one is long agree, so do all after them.
            same = at > start + len(new) and last[at] == old[at - shift]
            agreed = agreed + 1 if same else 0
            if agreed >= self.vocabulary.longest:
                last += old[at + 1 - shift :]
                break
        else:
            at = len(data)
        self.data, self.last = data, last
        return at - start

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of all the bytes, or of a prefix."""
        at, found = len(self.data) if end is None else end, []
        while at > 0:
            token = self.last[at]
            found.append(self.vocabulary.ranks[token])
            at -= len(token)
        return found[::-1]


class Encoder:
    """Encodes texts, each match of the pattern separately.

    Encodings of pieces are kept; when there are too many, those not used lately are forgotten.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(text) for text in texts]
        if len(self.known) > CACHED_PIECES:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for piece in set().union(*split):
            if piece not in known:
                if piece in older:
                    known[piece] = older[piece]
                else:
                    new.append((piece.encode(), piece))
        # In order, so that each piece goes on from the prefix it shares with the one before.
        new.sort()
        prefixes = Prefixes(self.vocabulary)
        for data, piece in new:
            rank = self.vocabulary.ranks.get(data)
            if rank is None:
                shared, most = 0, min(len(data), len(prefixes.data))
                while shared < most and data[shared] == prefixes.data[shared]:
                    shared += 1
                prefixes.truncate(shared)
                prefixes.append(data[shared:])
                known[piece] = pack(*prefixes.ids())
            else:
                known[piece] = pack(rank)
        return [np.frombuffer(b"".join(map(known.__getitem__, x)), "<u4") for x in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids.tolist()))

    def append(self, text: str, ids: np.ndarray, more: str) -> np.ndarray:
        """The encoding of ``text + more`` from that of ``text``.

        More text can change the last two matches at most ("'l" and "l" make "'ll").
        """
        tail = self.split(text)[-2:]
        kept = len(ids) - sum(map(len, self.encode_all(tail)))
        return np.concatenate([ids[:kept], self.encode("".join(tail) + more)])


_encoders: dict[str, Encoder] = {}


def _encoder(key: str, ranks, pattern: str) -> Encoder:
    """This Python worker's encoder; it lives on between tasks."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks.value, pattern)
    return _encoders[key]


def _pieces_of(batches: Iterator[pa.RecordBatch], chars: int = BATCH_CHARS):
    """Slices of the batches with a bounded amount of text each."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(0)).fill_null(0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + chars, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _run(docs: DataFrame, text: str, path: str, pattern: str, fields: dict, make) -> DataFrame:
    """One struct column of ``fields``, made from (encoder, ids), beside the input's columns."""
    spark = docs.sparkSession
    # The rank file has a fixed size; the documents are never sent to the driver.
    ranks = spark.sparkContext.broadcast(read_ranks(path))
    key = hashlib.sha256(f"{path}\n{pattern}".encode()).hexdigest()
    # Plain names on the way through Python; any name is possible outside.
    names = [f"c{k}" for k in range(len(docs.columns))]
    schema = StructType(
        [StructField(c, f.dataType) for c, f in zip(names, docs.schema, strict=True)]
        + [StructField(c, t) for c, t in fields.items()]
    )
    order = docs.select(
        quoted(text).alias("value"),
        *[quoted(c).alias(n) for c, n in zip(docs.columns, names, strict=True)],
    )

    @giving_back
    def run(batches):
        encoder = _encoder(key, ranks, pattern)
        for batch in _pieces_of(batches):
            texts = [x or "" for x in batch.column(0).to_pylist()]
            made = [make(encoder, ids) for ids in encoder.encode_all(texts)]
            columns = [
                pa.array([m[i] for m in made], _arrow(t)) for i, t in enumerate(fields.values())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *columns], names=[*names, *fields]
            )

    return order.mapInArrow(run, schema).toDF(*docs.columns, *fields)


def _arrow(kind):
    return {StringType(): pa.string(), LongType(): pa.int64()}.get(kind) or (
        pa.list_(pa.int32()) if isinstance(kind, ArrayType) else pa.binary()
    )


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "tokens"
) -> DataFrame:
    """The rows with their token ids as array<int> in the column ``into``."""
    kept = docs.select(*[quoted(c) for c in docs.columns if c != into])
    fields = {into: ArrayType(IntegerType())}
    return _run(kept, text, path, pattern, fields, lambda _, ids: (ids.astype("i4"),))


def decode(rows: DataFrame, path: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """The rows with the bytes of their token ids in the column ``into``; null for null ids."""
    ranks = rows.sparkSession.sparkContext.broadcast(read_ranks(path))

    @F.pandas_udf("binary")
    def bytes_of(ids):
        tokens_by_rank = {rank: token for token, rank in ranks.value.items()}
        return ids.map(
            lambda x: None if x is None else b"".join(map(tokens_by_rank.__getitem__, x))
        )

    return rows.withColumn(into, bytes_of(quoted(tokens)))


def _digests(encoder: Encoder, ids: np.ndarray):
    decoded = encoder.decode(ids)
    return (
        len(ids),
        hashlib.sha256(ids.tobytes()).hexdigest(),
        hashlib.sha256(decoded).hexdigest(),
    )


def op6_byte_bpe(spark, sf_dir):
    """Encodes and decodes in one pass and returns digests of both."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fields = {"n_tokens": LongType(), "ids_sha256": StringType(), "decoded_sha256": StringType()}
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return _run(docs, "text", path, public_tokenizers.PATTERN, fields, _digests).drop("text")


def stage(spark, docs, sf_dir):
    """The token ids of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    narrow = docs.select("doc_id", "lang", "source", "text")
    out = encode(narrow, path, public_tokenizers.PATTERN)
    return out.select(
        "doc_id", "lang", "source", "tokens", F.size("tokens").cast("bigint").alias("n_tokens")
    )
