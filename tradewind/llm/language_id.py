"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone. An n-gram's vector is
the product of its letters' vectors, each rotated by its place; a text's vector is the sum of those
of all its n-grams, and a language's prototype is the sum over its training texts. A text has the
language whose prototype has the greatest cosine with its vector.

Only prototypes leave the tasks, in the form of one row per task, language and dimension that is
summed up by Spark: their size is languages x dimensions, whatever the number of documents. The
number of languages is checked against a bound before the prototypes are sent to the tasks.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text if
there is nothing to learn from. Of equal cosines the first language in alphabetical order wins.
Texts without a letter and null languages are not learned from. Repeated rows count as often as
they occur and are predicted alike; an empty table gives no rows. ``predict`` reads only id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import quoted, table

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
MAX_LANGUAGES = 2000
#: N-grams whose vectors a Python worker keeps (a byte a dimension).
CACHED_GRAMS = 60_000
#: Texts that are turned into vectors at once.
TEXTS = 128

_space = 0


class Profiles:
    """Letter and n-gram vectors, made when first needed."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((0, dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= 50_000:
                self.letters.clear()
            bits = np.random.default_rng([code, self.dimensions]).integers(0, 2, self.dimensions)
            self.letters[code] = (2 * bits - 1).astype(np.int8)
        return self.letters[code]

    def _gram(self, gram: int) -> np.ndarray:
        vector = np.ones(self.dimensions, np.int8)
        for place in range(GRAM):
            vector = vector * np.roll(self.letter(gram >> (21 * place) & 0x1FFFFF), place)
        return vector

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """Rows of ``vectors`` for distinct n-grams."""
        if len(self.rows) + len(grams) > max(CACHED_GRAMS, len(grams)):
            self.rows, self.vectors = {}, self.vectors[:0]
        new = [g for g in grams.tolist() if g not in self.rows]
        if new:
            first = len(self.rows)
            self.rows.update((g, first + i) for i, g in enumerate(new))
            if first + len(new) > len(self.vectors):
                grown = np.empty((2 * (first + len(new)), self.dimensions), np.int8)
                grown[:first] = self.vectors[:first]
                self.vectors = grown
            for i, g in enumerate(new):
                self.vectors[first + i] = self._gram(g)
        return np.array([self.rows[g] for g in grams.tolist()], np.int64)

    def bundle(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' vectors as rows, and which texts have a letter at all."""
        counted = [grams_of(text) for text in texts]
        has_letter = np.array([x is not None for x in counted])
        found = [(i, *x) for i, x in enumerate(counted) if x is not None]
        # Whole numbers: exact as long as they fit the kind.
        most = max((int(x[2].sum()) for x in found), default=0)
        kind = np.float32 if most < 1 << 24 else np.float64
        out = np.zeros((len(texts), self.dimensions), kind)
        if found:
            every = np.concatenate([x[1] for x in found])
            grams, column = np.unique(every, return_inverse=True)
            counts = np.zeros((len(texts), len(grams)), kind)
            row = np.repeat([x[0] for x in found], [len(x[1]) for x in found])
            counts[row, column] = np.concatenate([x[2] for x in found])
            rows = self.lookup(grams)
            for start in range(0, len(rows), 4096):
                part = self.vectors[rows[start : start + 4096]].astype(kind)
                out += counts[:, start : start + 4096] @ part
        return out, has_letter


_is_letter = np.zeros(0x110000, bool)
_lower = np.arange(0x110000, dtype=np.int64)


def _prepare() -> None:
    """Which code points are letters, and their lower case, once a worker."""
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            _is_letter[code] = True
            low = c.lower()
            _lower[code] = ord(low) if len(low) == 1 else code


def grams_of(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct n-grams over lower-case letters and single word borders, with their counts."""
    if not text:
        return None
    if not _is_letter[ord("a")]:
        _prepare()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter[codes]
    if not letter.any():
        return None
    # Runs of other characters become one border; there is one before and after the text.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    line = np.where(letter, _lower[codes], _space)[kept]
    if line[0] != _space:
        line = np.concatenate([[_space], line])
    if line[-1] != _space:
        line = np.concatenate([line, [_space]])
    grams = np.zeros(len(line) - GRAM + 1, np.int64)
    for place in range(GRAM):
        grams |= line[place : place + len(grams)] << (21 * place)
    return np.unique(grams, return_counts=True)


_profiles: dict[int, Profiles] = {}


def _worker_profiles(dimensions: int) -> Profiles:
    """This Python worker's vectors; they live on between tasks."""
    if dimensions not in _profiles:
        _profiles[dimensions] = Profiles(dimensions)
    return _profiles[dimensions]


def _parts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            yield batch.slice(start, TEXTS)


def prototypes(
    docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS
) -> dict[str, np.ndarray]:
    """The sum of the vectors of each language's texts."""

    def add_up(batches):
        profiles, sums = _worker_profiles(dimensions), {}
        for part in _parts(batches):
            vectors, has_letter = profiles.bundle(part.column(0).to_pylist())
            langs = np.array(part.column(1).to_pylist(), object)
            for name in set(langs[has_letter]):
                total = vectors[has_letter & (langs == name)].sum(0, dtype=np.float64)
                sums[name] = sums.get(name, 0) + total.astype(np.int64)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * dimensions, pa.string()),
                    pa.array(range(dimensions), pa.int32()),
                    pa.array(total, pa.int64()),
                ],
                names=["lang", "dimension", "value"],
            )

    known = docs.select(quoted(text).alias("text"), quoted(lang).cast("string").alias("lang"))
    known = known.where("text is not null and lang is not null")
    summed = (
        known.mapInArrow(add_up, "lang string, dimension int, value bigint")
        .groupBy("lang", "dimension")
        .agg(F.sum("value").alias("value"))
    )
    rows = summed.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("dimension", "value"))).alias("values")
    )
    # One row of fixed size per language.
    found = rows.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    return {r["lang"]: np.array([v["value"] for v in r["values"]], np.float64) for r in found}


def predict(
    docs: DataFrame,
    learned: dict[str, np.ndarray],
    id_col: str = "doc_id",
    text: str = "text",
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """id, lang_pred and score (the cosine, 0 if it is below) of every row."""
    names = sorted(learned)
    scaled = [learned[n] / (np.linalg.norm(learned[n]) or 1) for n in names]
    sent = docs.sparkSession.sparkContext.broadcast(
        np.array(scaled, np.float32).reshape(len(names), dimensions)
    )

    def run(batches):
        profiles, prototype = _worker_profiles(dimensions), sent.value
        for part in _parts(batches):
            vectors, has_letter = profiles.bundle(part.column(1).to_pylist())
            if names:
                sizes = np.linalg.norm(vectors, axis=1)
                cosines = (vectors @ prototype.T) / np.where(sizes > 0, sizes, 1)[:, None]
                best = cosines.argmax(1)
                score = np.clip(cosines[np.arange(len(best)), best], 0, 1)
                guess = [names[i] if x else UNKNOWN for i, x in zip(best, has_letter, strict=True)]
                score = np.where(has_letter, score, 0.0)
            else:
                guess, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(guess, pa.string()), pa.array(score, pa.float64())],
                names=["id", "lang_pred", "score"],
            )

    kind = docs.select(quoted(id_col)).schema[0].dataType.simpleString()
    narrow = docs.select(quoted(id_col).alias("id"), quoted(text).alias("text"))
    out = narrow.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept back from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    learned = prototypes(docs.where(~held_out(F.col("doc_id"))))
    out = predict(docs, learned)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
