"""BPE with word ends, encoded over a trie of the distinct words.

The distinct words of a batch of texts go into a trie, whose nodes are their shared prefixes. Depth first,
every node gets the one token that a valid encoding of its prefix ends with, found from the states of
the nodes above; so the encoding of a prefix is worked out once, however many words begin with it.
A word's ids are read by going back from its last node, token by token.

A word is a run of symbols: its bytes, of which the last is marked as the word's end. A token may
follow another one if replaying the merges of both never merges across their border first. Merges
follow their ranks, the leftmost of equal ranks first.

Text is cut up as the tokenizer file says: special tokens first, then the rest in normal form C and
lower case, then by the file's pattern. Characters whose class or lower case is not the same here and in the
tokenizers library, as both follow some version of Unicode, are found one by one; a text with one of
them is normalized and cut by the library.

Defined results: a null text is encoded like an empty one, to no tokens. Each row is encoded by
itself, so repeated rows get equal results; an empty table gives an empty one. Texts are taken whole, and a
single word may be as long as its text: the trie takes some 30 bytes a node. ``encode`` returns the input's columns
unchanged, whatever they are called, and one more. Files with other steps than these are refused.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from array import array
from collections import defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
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
from tokenizers import Tokenizer

from tradewind.llm.common import quoted, table
from tradewind.llm.textscan import parts

INFINITE = 1 << 62
#: Words whose ids a Python worker keeps, and as many that were used before them; none beyond that length.
CACHED_WORDS = 250_000
CACHED_CHARS = 64
CACHED_PAIRS = 400_000
#: Bytes of text whose words share a trie.
BATCH_BYTES = 4 << 20
#: Symbols from here on are bytes that end a word.
END = 256
WORD_END = "</w>"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a tokenizer file: printable ones for themselves."""
    shown = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def symbols_of(word: str) -> str:
    """A word's bytes as characters, the last one marked."""
    data = word.encode()
    return data[:-1].decode("latin-1") + chr(END + data[-1])


class Vocabulary:
    """Tokens as runs of symbols, with what the compatibility of two of them needs."""

    def __init__(self, model: dict):
        letters = byte_letters()
        symbols = {c: chr(b) for c, b in letters.items()}
        symbols |= {c + WORD_END: chr(END + b) for c, b in letters.items()}
        self.merges: dict[tuple[str, str], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            symbols[a + b] = symbols[a] + symbols[b]
            self.merges.setdefault((symbols[a], symbols[b]), rank)
        self.ids = {s: model["vocab"][token] for token, s in symbols.items()}
        #: Ends of tokens; true for whole tokens.
        self.ends = {s[-n:]: False for s in self.ids for n in range(1, len(s))}
        self.ends.update(dict.fromkeys(self.ids, True))
        self._edges: dict[str, tuple[bool, list, list]] = {}
        #: What is known of the tokens that may follow a token.
        self.after: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self._n_pairs = 0

    def _edges_of(self, token: str) -> tuple[bool, list, list]:
        """Whether merging yields the token, and what stood at its edges until which rank."""
        known = self._edges.get(token)
        if known is None:
            merged, left, right = list(token), [], []
            while len(merged) > 1:
                rank, at = min(
                    (self.merges.get(pair, INFINITE), k) for k, pair in enumerate(pairwise(merged))
                )
                if rank == INFINITE:
                    break
                if at == 0:
                    left.append((merged[0], rank))
                if at == len(merged) - 2:
                    right.append((merged[-1], rank))
                merged[at : at + 2] = [merged[at] + merged[at + 1]]
            left.append((merged[0], INFINITE))
            right.append((merged[-1], INFINITE))
            known = self._edges[token] = (len(merged) == 1, left, right)
        return known

    def learn(self, a: str, b: str) -> bool:
        """Find out, and keep, whether token ``b`` may follow ``a``, or begin a word if that is empty."""
        if self._n_pairs >= CACHED_PAIRS:
            self.after.clear()
            self._n_pairs = 0
        self._n_pairs += 1
        fits = self.after[a][b] = self._replay(a, b)
        return fits

    def _replay(self, a: str, b: str) -> bool:
        whole, left, _ = self._edges_of(b)
        if not whole or not a:
            return whole
        right, i, j = self._edges_of(a)[2], 0, 0
        while True:
            (x, x_until), (y, y_until) = right[i], left[j]
            rank = self.merges.get((x, y), INFINITE)
            if rank < x_until and rank <= y_until and rank < INFINITE:
                return False
            if x_until == y_until == INFINITE:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1


class Trie:
    """Sorted words as a trie in depth-first order, with the last token of every prefix."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        self.vocabulary = vocabulary
        #: Per node, the token its prefix ends with, and the node at which that one begins.
        self.last: list[str] = [""]
        self.begin = array("q", [0])
        #: The last node of each word.
        self.leaves = array("q")
        path, before = [0], ""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del path[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                self._add(word, end, path)
            self.leaves.append(path[-1])
            before = word

    def _add(self, word: str, end: int, path: list[int]) -> None:
        """A node for ``word[:end]``; ``path`` has the nodes of all shorter prefixes."""
        vocabulary, last = self.vocabulary, self.last
        ends, after = vocabulary.ends, vocabulary.after
        for start in range(end - 1, -1, -1):
            token = word[start:end]
            whole = ends.get(token)
            if whole:
                previous = last[path[start]]
                fits = after[previous].get(token)
                if fits is None:
                    fits = vocabulary.learn(previous, token)
                if fits:
                    path.append(len(last))
                    last.append(token)
                    self.begin.append(path[start])
                    return
            elif whole is None:
                break
        raise ValueError(f"no token ends at symbol {end}; single symbols must be tokens")

    def ids(self, leaf: int) -> list[int]:
        found, ids = [], self.vocabulary.ids
        while leaf:
            found.append(ids[self.last[leaf]])
            leaf = self.begin[leaf]
        return found[::-1]


def _steps(step: dict | None, *path: str) -> list[dict]:
    return [] if step is None else step.get(path[0], [step])


class Encoder:
    """Encodes texts as a tokenizer file says.

    Ids of words are kept; when there are too many, those not used lately are forgotten.
    """

    def __init__(self, file: str):
        given = json.loads(file)
        normal, cut = given["normalizer"], given["pre_tokenizer"]
        model, added = given["model"], given["added_tokens"]
        kinds = [s["type"] for s in _steps(normal, "normalizers") + _steps(cut, "pretokenizers")]
        if kinds != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] or (
            model["type"], model.get("end_of_word_suffix"), model.get("ignore_merges", False),
            model.get("dropout"), model.get("continuing_subword_prefix"), given.get("decoder"),
        ) != ("BPE", WORD_END, False, None, None, None):
            raise ValueError("not a tokenizer file of the kind that is encoded here")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens must be matched as they are")
        self.library = Tokenizer.from_str(file)
        self.vocabulary = Vocabulary(model)
        self.split = regex.compile(cut["pretokenizers"][0]["pattern"]["Regex"]).findall
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, contents)) or r"(?!)")
        self.tokens = {n: token for token, n in model["vocab"].items()}
        self.tokens |= {t["id"]: t["content"] for t in added}
        self.decimals = {n: str(n) for n in self.tokens}
        #: A special token's key has a space before it, which no word has.
        self.fixed = {f" {t['content']}": struct.pack("<I", t["id"]) for t in added}
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.usual: set[str] = set()
        self.odd: set[str] = set()

    # --- cutting up -----------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The words of a text, and its special tokens by their keys."""
        new = set(text) - self.usual
        if new:
            self._look_at(new - self.odd)
        cut = self._cut_exactly if new & self.odd else self._cut
        if not self.special.search(text):
            return cut(text)
        found, at = [], 0
        for match in self.special.finditer(text):
            found += cut(text[at : match.start()])
            found.append(f" {match.group()}")
            at = match.end()
        return found + cut(text[at:])

    def _cut(self, text: str) -> list[str]:
        # The library takes the lower case of each character alone; only sigma's depends on others.
        return self.split(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _cut_exactly(self, text: str) -> list[str]:
        normal = self.library.normalizer.normalize_str(text)
        return [
            bytes(map(self.letters.__getitem__, piece)).decode()
            for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)
        ]

    def _look_at(self, characters: set[str]) -> None:
        """Sort new characters into those that are cut alike here and by the library, and others."""
        for c in characters:
            known = unicodedata.category(c) != "Cn"
            same = known and all(self._cut(s) == self._cut_exactly(s) for s in (f"a{c}{c}a1{c}.", c))
            (self.usual if same else self.odd).add(c)

    # --- encoding ---------------------------------------------------------------

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.words(text) for text in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        known, older, fixed, new = self.known, self.older, self.fixed, []
        for word in set().union(*split):
            if word not in known:
                if word in fixed:
                    known[word] = fixed[word]
                elif word in older:
                    known[word] = older[word]
                else:
                    new.append((symbols_of(word), word))
        new.sort()
        trie = Trie(self.vocabulary, [symbols for symbols, _ in new])
        for (_, word), leaf in zip(new, trie.leaves, strict=True):
            ids = trie.ids(leaf)
            known[word] = struct.pack(f"<{len(ids)}I", *ids)
        out = [np.frombuffer(b"".join(map(known.__getitem__, x)), "<u4") for x in split]
        for _, word in new:
            if len(word) > CACHED_CHARS:
                del known[word]
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens with spaces between, as a file without a decoder has it."""
        return " ".join(map(self.tokens.__getitem__, ids))


_encoders: dict[str, Encoder] = {}


def _encoder(file) -> Encoder:
    """This Python worker's encoder; it lives on between tasks."""
    key = hashlib.sha256(file.value.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(file.value)
    return _encoders[key]


def _file(spark, path: str):
    # Of fixed size; the documents are never sent to the driver.
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _with_fields(docs: DataFrame, text: str, path: str, fields: dict, make) -> DataFrame:
    """The input's columns and some more, made from (encoder, ids) of each row's text."""
    file = _file(docs.sparkSession, path)
    # Plain names on the way through Python; any name is possible outside.
    names = [f"c{k}" for k in range(len(docs.columns))]
    schema = StructType(
        [StructField(n, f.dataType) for n, f in zip(names, docs.schema, strict=True)]
        + [StructField(n, kind) for n, (kind, _) in fields.items()]
    )
    given = docs.select(
        quoted(text).cast("string").alias("value"),
        *[quoted(c).alias(n) for c, n in zip(docs.columns, names, strict=True)],
    )
    kinds = [kind for _, kind in fields.values()]

    def run(batches):
        encoder = _encoder(file)
        for batch in parts(batches, 0, BATCH_BYTES):
            texts = [x or "" for x in batch.column(0).to_pylist()]
            made = [make(encoder, ids) for ids in encoder.encode_all(texts)]
            columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*names, *fields])

    return given.mapInArrow(run, schema).toDF(*docs.columns, *fields)


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "tokens") -> DataFrame:
    """The rows with their token ids as array<int> in the column ``into``."""
    kept = docs.select(*[quoted(c) for c in docs.columns if c != into or c == text])
    fields = {into: (ArrayType(IntegerType()), pa.list_(pa.int32()))}
    return _with_fields(kept, text, path, fields, lambda _, ids: (ids.astype("i4"),))


def decode(rows: DataFrame, path: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """The rows with the text of their token ids in the column ``into``; null for null ids."""
    file = _file(rows.sparkSession, path)

    @F.pandas_udf("string")
    def text_of(ids):
        encoder = _encoder(file)
        return ids.map(lambda x: None if x is None else encoder.decode(x.tolist()))

    return rows.withColumn(into, text_of(quoted(tokens)))


def _digests(encoder: Encoder, ids: np.ndarray):
    numbers = ids.tolist()
    decimal = " ".join(map(encoder.decimals.__getitem__, numbers)).encode()
    decoded = encoder.decode(numbers).encode()
    return len(numbers), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(decoded).hexdigest()


def op11_word_bpe(spark, sf_dir):
    """Encodes and decodes in one pass and returns digests of both."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fields = {
        "n_tokens": (LongType(), pa.int64()),
        "ids_sha256": (StringType(), pa.string()),
        "decoded_sha256": (StringType(), pa.string()),
    }
    path = public_tokenizers.path("word_bpe_49k.json")
    return _with_fields(docs, "text", path, fields, _digests).drop("text")
