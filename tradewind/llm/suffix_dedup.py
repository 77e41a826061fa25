"""Substring dedup by sorted ranks of sampled strings, which takes the place of prefix doubling.

Removed is each byte covered by a 50-byte string that also starts in a document with a smaller id.

There is no loop of growing offsets that ranks anew until ranks are unique: the first rank is that of 20 bytes
at once, and one step from there reaches the threshold of 50. Doubling as such, over every position, removed
the same bytes in a trial but wrote 93 bytes of shuffle for each byte of text (see README).

Ranks are names of classes of equal strings, taken from hashes. Instead of all suffixes, those at anchors
are ranked (see ``anchors``): every 50-byte string names one, so equal strings are always compared.

1. Spark sorts the anchors' (rank of 20 bytes, rank of the strings around it, document). A rank that
   only one document has is unique and goes no further. Anchors that agree in both ranks have the
   same strings around them: all but the smallest document's are covered.
2. Where the 20 bytes agree but what is around differs, ranks are doubled: each string of 50 bytes gets
   the pair of the ranks of its halves, at offsets 0 and 25. Spark sorts these by the pair and
   document; past the threshold, all but the smallest document of each pair are covered. A string reaches 15
   bytes to the left of its anchor or 16 to the right. An anchor carries a few bits of a hash of either side, and
   the strings of a side on which no other document agrees go no further.
3. The covered spans are joined to their documents, merged and cut out.

Within a map task equal rows are combined before either shuffle, so that a passage which many documents
share, or a text with many copies, is sent once per scan. Groups of any size are streamed in sorted
order; nothing is held but a batch and what one document has.

Strings are told apart by hashes: two of 64 bits for step 1, two others of 64 bits for step 2.

Defined results: a null text counts as empty; texts under 50 bytes lose nothing; rows without an id lose
nothing and take nothing from others; rows of equal id are taken to repeat one document (if their texts
differ, each loses the spans found in any of them). Equal texts under equal ids are kept. An empty
table gives no rows. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.anchors import Anchors
from tradewind.llm.common import Scratch, fresh, give_back, giving_back, quoted, table
from tradewind.llm.textscan import Scan, mix, parts

SIZE = 50
HALF = SIZE // 2
#: Bytes of an anchor. Longer ones are more, and fewer of them agree by chance.
GRAM = 20
#: Text whose anchors are combined before the shuffle.
COMBINED_BYTES = 3 << 19
#: In one number: an anchor's first string, how many follow, and where in the first string the anchor is.
FOLLOW_BITS, OFFSET_BITS = 6, 5
#: The last bits of an anchor's key are hashes of its two sides; only the others say where it is sent.
SIDE_BITS = 10
#: Strings that begin so far before their anchor have its left side in common, others its right side.
REACH = (SIZE - GRAM) // 2
ANCHOR_SCHEMA = "key bigint, context bigint, doc bigint, place bigint"
NAMES = ["key", "context", "doc", "place"]
PAIR_NAMES = ["a", "b", "doc", "at"]


def _batch(names: list[str], columns) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _combined(keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray):
    """Rows in order of keys and document, and which are covered by a smaller document here."""
    order = np.lexsort((doc, *reversed(keys)))
    keys, doc, place = [k[order] for k in keys], doc[order], place[order]
    new = _changes(*keys)
    return keys, doc, place, doc > doc[new][np.cumsum(new) - 1]


def _sent(names: list[str], keys: list[np.ndarray], doc, place, covered) -> pa.RecordBatch:
    """Rows for the shuffle. Covered ones have no second key, and a first one that spreads them.

    In order of their documents, which are then packed better than in that of their hashes.
    """
    order = np.lexsort((place, doc))
    keys, doc, place, covered = [k[order] for k in keys], doc[order], place[order], covered[order]
    first = np.where(covered, mix(doc.astype(np.uint64)), keys[0])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(first.view(np.int64)),
            pa.array(keys[1].view(np.int64), mask=covered),
            pa.array(doc),
            pa.array(place),
        ],
        names=names,
    )


def _low(x: np.ndarray, bits: int) -> np.ndarray:
    return x & ((1 << bits) - 1)


def _sides(scan: Scan, found: Anchors) -> np.ndarray:
    """Hashes of both sides of anchors; a side that none of its strings reaches has none."""
    begin = np.where(found.place - found.first >= REACH, found.place - REACH, found.place)
    reach = np.where(found.place - found.last < REACH, SIZE - REACH + 1, 0)
    left = mix(scan.hashes(begin, found.place + GRAM))
    right = mix(scan.hashes(found.place, found.place + reach))
    rest = np.uint64(64 - SIDE_BITS)
    return ((left >> rest) << np.uint64(SIDE_BITS)) | (right >> rest)


class _Strings:
    """The strings of some anchors, from their places."""

    def __init__(self, place: np.ndarray):
        follow = place >> OFFSET_BITS
        self.first = follow >> FOLLOW_BITS
        self.last = self.first + _low(follow, FOLLOW_BITS)
        #: The last string that has the left side.
        self.middle = self.first + _low(place, OFFSET_BITS) - REACH


def _agree(group: np.ndarray, side: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether another document of its group has the same side."""
    if not len(doc):
        return np.zeros(0, bool)
    order = np.lexsort((doc, side, group))
    new = _changes(group[order], side[order])
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(doc)) - 1
    out = np.empty(len(doc), bool)
    out[order] = (doc[order][ends] > doc[order][begins])[np.cumsum(new) - 1]
    return out


def _narrowed(group: np.ndarray, key: np.ndarray, doc: np.ndarray, place: np.ndarray):
    """Document, first and last string of what is left open of anchors whose group is all here."""
    s = _Strings(place)
    left, right = s.first <= s.middle, s.last > s.middle
    left[left] = _agree(group[left], _low(key[left] >> SIDE_BITS, SIDE_BITS), doc[left])
    right[right] = _agree(group[right], _low(key[right], SIDE_BITS), doc[right])
    first = np.where(left, s.first, np.maximum(s.first, s.middle + 1))
    last = np.where(right, s.last, np.minimum(s.last, s.middle))
    some = left | right
    return doc[some], first[some], last[some]


@giving_back
def _anchor_rows(batches: Iterator[pa.RecordBatch]):
    """Anchors with both ranks; those covered by a smaller document of the same scan are marked."""
    for part in parts(batches, 1, COMBINED_BYTES):
        scan = Scan(part.column(1))
        found = Anchors(len(scan.data), scan.offsets, scan.hashes, SIZE, GRAM)
        if len(found.key):
            doc = part.column(0).to_numpy()[found.text]
            place = found.first - scan.offsets[found.text]
            place = (place << FOLLOW_BITS) + (found.last - found.first)
            place = (place << OFFSET_BITS) + (found.place - found.first)
            keep = np.uint64((1 << 64) - (1 << 2 * SIDE_BITS))
            key = (found.key & keep) | _sides(scan, found)
            yield _sent(NAMES, *_combined([key, found.context], doc, place))


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows begin a new run of equal keys; the first row does."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


class _Least:
    """The smallest document of the run that each of the sorted rows is in, across batches."""

    def __init__(self):
        self.key, self.doc = None, 0

    def __call__(self, doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
        new = _changes(*keys)
        new[0] = self.key != tuple(k[0] for k in keys)
        out = np.concatenate([[self.doc], doc[new]])[np.cumsum(new)]
        self.key, self.doc = tuple(k[-1] for k in keys), out[-1]
        return out


SPAN_NAMES = ["open", "doc", "first", "last"]
SPAN_SCHEMA = "open boolean, doc bigint, first bigint, last bigint"


def _spans(is_open: bool, doc, first, last) -> pa.RecordBatch:
    return _batch(SPAN_NAMES, [np.full(len(doc), is_open), doc, first, last])


@giving_back
def _settle(batches: Iterator[pa.RecordBatch]):
    """Covered spans, and open ranges: the begins of strings whose ranks are neither unique nor settled."""

    def spans(is_open: bool, doc, place):
        of = _Strings(place)
        return _spans(is_open, doc, of.first, of.last + (1 if is_open else SIZE))

    least_of = _Least()
    known, context_of, several_of, waiting = None, None, False, []
    for batch in batches:
        is_span = pc.is_null(batch.column(1))
        _, _, doc, place = _columns(batch.filter(is_span))
        if len(doc):
            yield spans(False, doc, place)
        sided, context, doc, place = _columns(batch.filter(pc.invert(is_span)))
        if not len(sided):
            continue
        # Equal contexts have equal sides.
        covered = doc > least_of(doc, sided, context)
        key = sided >> 2 * SIDE_BITS
        # Open are keys that occur with several contexts.
        new = _changes(key)
        group, one = np.cumsum(new) - 1, context[new]
        goes_on = known == key[0]
        if goes_on:
            one[0] = context_of
        several = np.zeros(len(one), bool)
        several[group[context != one[group]]] = True
        if goes_on:
            several[0] |= several_of
        # Anchors of the last key wait while it has a single context: it may be unique.
        if not goes_on:
            waiting = []
        elif several[0]:
            for w in waiting:
                yield spans(True, *w)
            waiting = []
        elif group[-1] > 0:
            waiting = []
        if not several[-1]:
            rest = (group == group[-1]) & ~covered
            waiting.append((doc[rest], place[rest]))
        known, context_of, several_of = key[-1], one[-1], several[-1]
        yield spans(False, doc[covered], place[covered])
        still = several[group] & ~covered
        # Of keys that other batches have too, all is open.
        partly = (group == group[-1]) | ((group == 0) & goes_on)
        some = still & partly
        yield spans(True, doc[some], place[some])
        some = still & ~partly
        open_doc, first, last = _narrowed(group[some], sided[some], doc[some], place[some])
        yield _spans(True, open_doc, first, last + 1)


@giving_back
def _merge(batches: Iterator[pa.RecordBatch]):
    """One row (doc, runs) per document: its spans, sorted by begin, united where they touch."""

    def united(doc, first, last):
        new = _changes(doc)
        # Documents are set apart, so that one running maximum serves them all.
        apart = (np.cumsum(new) - 1) * (int(last.max()) + 2)
        reach = np.maximum.accumulate(last + apart)
        new[1:] |= first[1:] + apart[1:] > reach[:-1]
        begins = np.flatnonzero(new)
        return doc[begins], first[begins], np.maximum.reduceat(last, begins)

    def rows(doc, first, last):
        begins = np.append(np.flatnonzero(_changes(doc)), len(doc))
        pairs = np.stack([first, last], axis=1).astype("<i8")
        packed = [pairs[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[begins[:-1]]), pa.array(packed, pa.binary())], names=["doc", "runs"]
        )

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = _columns(batch)
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        columns = united(*columns)
        done = columns[0] != columns[0][-1]
        if done.any():
            yield rows(*(c[done] for c in columns))
        held = [c[~done] for c in columns]
    if held is not None:
        yield rows(*held)


def runs_by_doc(spans: DataFrame) -> DataFrame:
    """(doc, runs): all spans of a document as packed pairs of begin and end."""
    sorted_spans = (
        spans.select("doc", "first", "last")
        .repartition("doc")
        .sortWithinPartitions("doc", "first")
    )
    return sorted_spans.mapInArrow(_merge, "doc bigint, runs binary")


@giving_back
def _open_bytes(batches: Iterator[pa.RecordBatch]):
    """(doc, runs, bytes): of each text only the strings that begin in its ranges, range by range."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        ranges, cut_out = [], []
        for text, runs in zip(texts, batch.column(2).to_pylist(), strict=True):
            pairs = np.minimum(np.frombuffer(runs, "<i8").reshape(-1, 2), len(text) - SIZE + 1)
            pairs = pairs[pairs[:, 0] < pairs[:, 1]]
            ranges.append(pairs.tobytes())
            cut_out.append(b"".join(text[a : b + SIZE - 1] for a, b in pairs.tolist()))
        columns = [batch.column(0), *(pa.array(c, pa.binary()) for c in (ranges, cut_out))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "runs", "bytes"])


@giving_back
def _pair_rows(batches: Iterator[pa.RecordBatch]):
    """(a, b, doc, at): the ranks of both halves of every string that begins in a document's ranges."""
    for part in parts(batches, 2):
        scan = Scan(part.column(2))
        begins, docs, places = [], [], []
        ids = part.column(0).to_numpy()
        for k, runs in enumerate(part.column(1).to_pylist()):
            first, last = np.frombuffer(runs, "<i8").reshape(-1, 2).T
            sizes = last - first
            at = np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
            # Where the ranges lie among the bytes that were cut out.
            shift = np.cumsum(sizes + SIZE - 1) - (sizes + SIZE - 1) - first
            places.append(at)
            begins.append(at + np.repeat(shift, sizes) + scan.offsets[k])
            docs.append(np.full(len(at), ids[k]))
        begin = np.concatenate(begins)
        middle = begin + HALF
        ranks = [mix(scan.hashes(begin, middle)), mix(scan.hashes(middle, begin + SIZE))]
        ranks, doc, at, covered = _combined(ranks, np.concatenate(docs), np.concatenate(places))
        for start in range(0, len(doc), 100_000):
            s = slice(start, start + 100_000)
            yield _sent(PAIR_NAMES, [r[s] for r in ranks], doc[s], at[s], covered[s])


@giving_back
def _cover(batches: Iterator[pa.RecordBatch]):
    least_of = _Least()
    for batch in batches:
        is_span = pc.is_null(batch.column(1))
        _, _, doc, at = _columns(batch.filter(is_span))
        if len(doc):
            yield _spans(False, doc, at, at + SIZE)
        a, b, doc, at = _columns(batch.filter(pc.invert(is_span)))
        if len(doc):
            covered = doc > least_of(doc, a, b)
            yield _spans(False, doc[covered], at[covered], at[covered] + SIZE)


def covered_runs(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc, runs) of every document that loses anything: packed begins and ends, in bytes."""
    scratch = Scratch(docs.sparkSession)
    given = docs.select(quoted(id_col).cast("bigint").alias("doc"), quoted(text).alias("text"))
    given = given.where("doc is not null and text is not null")
    anchors = given.mapInArrow(_anchor_rows, ANCHOR_SCHEMA)
    group = F.shiftright("key", 2 * SIDE_BITS)
    by_rank = anchors.repartition(group).sortWithinPartitions("key", "context", "doc")
    settled = scratch.put("settled", by_rank.mapInArrow(_settle, SPAN_SCHEMA))
    open_ranges = runs_by_doc(settled.where("open"))
    # Merged at every size, so that the cost grows evenly with the input. What is cut out of the
    # texts is written, so that their shuffle files are gone before the pairs make theirs.
    texts = given.hint("merge").join(open_ranges, "doc").select("doc", "text", "runs")
    pairs = scratch.put(
        "open", texts.mapInArrow(_open_bytes, "doc bigint, runs binary, bytes binary")
    )
    by_pair = (
        pairs.mapInArrow(_pair_rows, "a bigint, b bigint, doc bigint, at bigint")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "doc")
    )
    doubled = scratch.put("doubled", by_pair.mapInArrow(_cover, SPAN_SCHEMA))
    scratch.drop("open")
    spans = settled.where("not open").unionAll(doubled)
    return scratch.put("runs", runs_by_doc(spans))


def cut(data: bytes, runs: bytes | None) -> tuple[bytes, int, int]:
    """What is left of a text without its covered runs; the bytes and runs that are gone."""
    if runs is None:
        return data, 0, 0
    kept, at, gone, n = [], 0, 0, 0
    for first, last in np.frombuffer(runs, "<i8").reshape(-1, 2).tolist():
        last = min(last, len(data))
        if first < last:
            kept.append(data[at:first])
            at, gone, n = last, gone + last - first, n + 1
    kept.append(data[at:])
    return b"".join(kept), gone, n


@giving_back
def _digest(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        rows = []
        for text, runs in zip(
            batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
        ):
            data = (text or "").encode()
            kept, gone, n = cut(data, runs)
            rows.append((len(data), gone, n, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *(pa.array(c, pa.int64()) for c in columns[:3]),
                pa.array(columns[3], pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def op9_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = covered_runs(docs, "doc_id", "text")
    joined = docs.hint("merge").join(runs, docs["doc_id"] == runs["doc"], "left")
    joined = joined.select("doc_id", "text", "runs")
    return joined.mapInArrow(
        _digest,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )


def remove_covered(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their covered bytes cut out of the text.

    A cut may fall inside a character; the bytes that are left of it are dropped.
    """
    doc, runs = fresh("doc"), fresh("runs")
    found = covered_runs(docs, id_col, text).toDF(doc, runs)

    @F.pandas_udf("string")
    def without(texts: pd.Series, packed: pd.Series) -> pd.Series:
        pairs = zip(texts, packed, strict=True)
        left = pd.Series([cut(t.encode(), r)[0].decode("utf-8", "ignore") for t, r in pairs])
        give_back()
        return left

    joined = docs.hint("merge").join(found, quoted(id_col).cast("bigint") == F.col(doc), "left")
    texts = F.coalesce(quoted(text), F.lit(""))
    fewer = F.when(F.col(runs).isNull(), quoted(text)).otherwise(without(texts, F.col(runs)))
    return joined.select(*[(fewer.alias(c) if c == text else quoted(c)) for c in docs.columns])


def stage(spark, docs, sf_dir):
    """All documents, without the passages of 50 bytes or more that an earlier one has."""
    out = remove_covered(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
