"""Substring dedup with automata of recurring passages.

Removed is each word covered by a window of 35 words whose word sequence also starts anywhere else, the
same document included.

1. Recurring passages are confirmed from anchors (see ``anchors``), of which equal windows have equal ones.
   Anchors that agree in all their windows make these a passage. Where anchors agree but what is around
   them differs, the windows themselves are compared, by hashes of both halves.
2. The documents are dealt into shards of bounded size. For each shard, every passage that occurs in it is
   sent once, however often it occurs there, and an Aho-Corasick automaton over words is compiled from them.
3. All documents of a shard are streamed through its automaton, which locates every occurrence of every
   passage, and the covered words go.

A passage shared by many documents is combined before the shuffle, within a map task and shard; groups of any
size are streamed in sorted order. A shard's texts and automaton are what a task holds.

Words are told apart by hashes of 64 bits, windows by two of them.

Defined results: a null text has no words; texts under 35 words lose nothing; rows without an id lose nothing
and are not compared; rows of equal id and text repeat one document, so that all its windows recur; those of equal
id and other text are other documents. An empty table gives no rows. Only id and text are read, so other columns
cannot clash.

Rows without id or text never meet. Repeated rows are combined before the shuffle and in their shard, where one of
them is held; the shard's task writes the result of each. Documents are told apart by a hash of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.anchors import Anchors, stretch_hashes
from tradewind.llm.common import Scratch, quoted, table
from tradewind.llm.suffix_dedup import _batch, _changes, _columns, runs_by_doc
from tradewind.llm.textscan import REPEATS_SCHEMA, SPACE, Scan, combine_repeats, mix, parts

SIZE = 35
HALF = SIZE // 2
#: Text of a shard.
SHARD_BYTES = 2 << 20
#: Bytes of a word's hash that the automaton reads.
LETTERS = 3
#: Equal rows of the result that are made of one.
MOST_COPIES = 1024

ANCHOR_SCHEMA = (
    "key bigint, context bigint, shard bigint, doc bigint, first bigint, last bigint, n bigint"
)
ANCHOR_NAMES = [c.split()[0] for c in ANCHOR_SCHEMA.split(", ")]
PASSAGE_NAMES = ["open", "doc", "first", "last"]
PASSAGE_SCHEMA = "open boolean, doc bigint, first bigint, last bigint"


def _anchor_rows(batches: Iterator[pa.RecordBatch]):
    """Anchors by document and place in words; of equal ones in a shard, one with their number."""
    for part in parts(batches, 2):
        scan = Scan(part.column(2))
        begins, ends, bounds = scan.words()
        words = mix(scan.hashes(begins, ends))
        found = Anchors(len(words), bounds, stretch_hashes(words), SIZE, HALF)
        if not len(found.key):
            continue
        doc, shard = (part.column(i).to_numpy()[found.text] for i in (0, 1))
        begin = bounds[found.text]
        order = np.lexsort((shard, found.context, found.key))
        columns = [found.key, found.context, shard, doc, found.first - begin, found.last - begin]
        columns = [c[order] for c in columns]
        starts = np.flatnonzero(_changes(*columns[:3]))
        n = np.diff(np.append(starts, len(doc)))
        yield _batch(ANCHOR_NAMES, [*(c[starts] for c in columns), n])


def _passages(is_open: bool, doc, first, last) -> pa.RecordBatch:
    return _batch(PASSAGE_NAMES, [np.full(len(doc), is_open), doc, first, last])


def _confirm(batches: Iterator[pa.RecordBatch]):
    """Recurring passages, once a shard; and open ranges, the begins of windows still to be compared.

    Rows come sorted by key, context and shard. Of an anchor that may still be alone with its context, and
    of a key's first context, a row is kept until more is known.
    """
    last_row, total, single, first_row, several = None, 0, None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = _columns(batch)
        key, context, shard, doc, first, last, n = columns
        new_run, new_shard = _changes(key, context), _changes(key, context, shard)
        new_key = _changes(key)
        same_key = last_row is not None and last_row[0] == key[0]
        same_run = same_key and last_row[1] == context[0]
        new_key[0], new_run[0] = not same_key, not same_run
        new_shard[0] = not (same_run and last_row[2] == shard[0])

        # Contexts: a run that goes on has what was counted before.
        run = np.cumsum(new_run) - new_run[0]
        totals = np.bincount(run, n)
        if same_run:
            totals[0] += total
            if single is not None and totals[0] > 1:
                yield _passages(False, *single)
        confirmed = (totals[run] > 1) & new_shard
        yield _passages(False, doc[confirmed], first[confirmed], last[confirmed] + SIZE)
        total = totals[-1]
        if total > 1:
            single = None
        elif new_run[-1]:
            single = (doc[-1:], first[-1:], last[-1:] + SIZE)

        # Keys: with several contexts, the windows of one anchor of each are to be compared.
        group = np.cumsum(new_key) - new_key[0]
        contexts = np.bincount(group, new_run)
        if same_key:
            contexts[0] += 2 if several else 1
            if contexts[0] > 1 and not several:
                yield _passages(True, *first_row)
        is_open = new_run & (contexts[group] > 1)
        yield _passages(True, doc[is_open], first[is_open], last[is_open] + 1)
        several = contexts[-1] > 1
        if new_key.any():
            at = np.flatnonzero(new_key)[-1:]
            first_row = (doc[at], first[at], last[at] + 1)
        last_row = (key[-1], context[-1], shard[-1])


def _pair_rows(batches: Iterator[pa.RecordBatch]):
    """(a, b, doc, at): the hashes of both halves of the windows that begin in open ranges."""
    for part in parts(batches, 1):
        scan = Scan(part.column(1))
        begins, ends, bounds = scan.words()
        hashes = stretch_hashes(mix(scan.hashes(begins, ends)))
        ids, places, texts = part.column(0).to_numpy(), [], []
        for k, runs in enumerate(part.column(2).to_pylist()):
            for first, last in np.frombuffer(runs, "<i8").reshape(-1, 2).tolist():
                at = np.arange(first, min(last, bounds[k + 1] - bounds[k] - SIZE + 1))
                places.append(at)
                texts.append(np.full(len(at), k))
        at, text = np.concatenate(places), np.concatenate(texts)
        begin = at + bounds[text]
        a = mix(hashes(begin, begin + HALF))
        b = mix(hashes(begin + HALF, begin + SIZE))
        yield _batch(["a", "b", "doc", "at"], [a, b, ids[text], at])


def _recurring(batches: Iterator[pa.RecordBatch]):
    """The windows that occur twice or more, from rows sorted by their hashes."""
    known, total, single = None, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, doc, at = _columns(batch)
        new = _changes(a, b)
        goes_on = known == (a[0], b[0])
        new[0] = not goes_on
        run = np.cumsum(new) - new[0]
        totals = np.bincount(run)
        if goes_on:
            totals[0] += total
            if single is not None:
                yield _passages(False, *single)
        twice = totals[run] > 1
        yield _passages(False, doc[twice], at[twice], at[twice] + SIZE)
        known, total = (a[-1], b[-1]), totals[-1]
        single = (doc[-1:], at[-1:], at[-1:] + SIZE) if total == 1 else None


def locate(words: np.ndarray, bounds: np.ndarray, begins: np.ndarray, ends: np.ndarray):
    """Which words are covered by an occurrence of any passage.

    Text ``k`` is ``words[bounds[k]:bounds[k + 1]]`` (hashes), passage ``p`` is
    ``words[begins[p]:ends[p]]``. The automaton reads three bytes of each word's hash, which keeps its
    nodes small; what it finds is compared by hashes of the whole stretch.
    """
    edges = np.zeros(len(words) + 1, np.int64)
    if len(begins):
        letters = words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LETTERS]
        line = letters.tobytes().decode("latin-1")
        hashes = stretch_hashes(words)
        wanted = hashes(begins, ends)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
            automaton.add_word(line[begin * LETTERS : end * LETTERS], p)
        automaton.make_automaton()
        found = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            text = line[a * LETTERS : b * LETTERS]
            found += [(a + (i + 1) // LETTERS, p) for i, p in automaton.iter(text) if (i + 1) % LETTERS == 0]
        if found:
            end, passage = np.array(found, np.int64).T
            begin = end - (ends - begins)[passage]
            right = hashes(begin, end) == wanted[passage]
            np.add.at(edges, begin[right], 1)
            np.add.at(edges, end[right], -1)
    return np.cumsum(edges[:-1]) > 0


def kept_texts(scan: Scan, begins, ends, bounds, kept: np.ndarray) -> list[bytes]:
    """Each text's kept words, joined by one space."""
    begins, ends = begins[kept], ends[kept]
    text = np.searchsorted(scan.offsets, begins, "right") - 1
    more = np.zeros(len(begins), bool)
    more[:-1] = text[1:] == text[:-1]
    # A word and the one byte after it, if another word follows in the text.
    edges = np.zeros(len(scan.data) + 2, np.int8)
    edges[begins] += 1
    edges[ends + more] -= 1
    mask = np.cumsum(edges[: len(scan.data)], dtype=np.int8) > 0
    line = np.where(SPACE[scan.data], np.uint8(0x20), scan.data)[mask]
    cuts = np.concatenate([[0], np.cumsum(mask)])[scan.offsets]
    return [line[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _shards(batches: Iterator[pa.RecordBatch]):
    """The rows of one shard after the other, each text once, with the numbers of copies by document;
    columns shard, doc, id, text, copies, runs."""
    held, number, known, current = [], {}, set(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        shards = batch.column(0).to_numpy()
        cuts = np.append(np.flatnonzero(_changes(shards)), len(shards))
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if held and current != shards[begin]:
                yield pa.Table.from_batches(held), number
                held, number, known = [], {}, set()
            current = shards[begin]
            part = batch.slice(begin, end - begin)
            needed = part.column("runs").is_valid().to_numpy(zero_copy_only=False).copy()
            is_text = part.column("text").is_valid().to_pylist()
            docs, copies = (part.column(c).to_pylist() for c in ("doc", "copies"))
            for k in np.flatnonzero(~needed).tolist():
                number[docs[k]] = number.get(docs[k], 0) + copies[k]
                if is_text[k] and docs[k] not in known:
                    known.add(docs[k])
                    needed[k] = True
            held.append(part.filter(pa.array(needed)))
    if held:
        yield pa.Table.from_batches(held), number


def _result(names: list[str], ids, texts, make, left, n_words, removed, copies) -> pa.RecordBatch:
    """A row for each text, or several that stand for its copies."""
    out = [
        make(texts[k], kept, int(n), int(r))
        for k, (kept, n, r) in enumerate(zip(left, n_words, removed, strict=True))
    ]
    if not out:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * len(names), names=names)
    several = -(-copies // MOST_COPIES)
    at = np.repeat(np.arange(len(out)), several)
    number = np.full(len(at), MOST_COPIES)
    number[np.cumsum(several) - 1] = copies - (several - 1) * MOST_COPIES
    columns = [ids, *(pa.array(c) for c in zip(*out, strict=True))]
    at = pa.array(at)
    return pa.RecordBatch.from_arrays([*(c.take(at) for c in columns), pa.array(number)], names=names)


def _stream(make, names: list[str]):
    """Compiles each shard's automaton, streams its documents and makes a row of each."""

    def run(batches: Iterator[pa.RecordBatch]):
        for rows, number in _shards(batches):
            is_text = pc.is_null(rows.column("runs"))
            texts, sent = rows.filter(is_text), rows.filter(pc.invert(is_text))
            scan = Scan(texts.column("text").combine_chunks())
            begins, ends, bounds = scan.words()
            words = mix(scan.hashes(begins, ends))
            docs = texts.column("doc").to_pylist()
            place = {d: k for k, d in enumerate(docs)}
            spans = [np.empty((0, 2), np.int64)]
            for doc, runs in zip(*(sent.column(c).to_pylist() for c in ("doc", "runs")), strict=True):
                runs, k = np.frombuffer(runs, "<i8").reshape(-1, 2), place[doc]
                spans.append(runs[runs[:, 1] <= bounds[k + 1] - bounds[k]] + bounds[k])
            gone = locate(words, bounds, *np.concatenate(spans).T)
            left = kept_texts(scan, begins, ends, bounds, ~gone)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[bounds])
            copies = np.array([number[d] for d in docs], np.int64)
            ids = texts.column("id").combine_chunks()
            yield _result(names, ids, texts.column("text"), make, left, np.diff(bounds), removed, copies)

    return run


def _whole(make, names: list[str]):
    """A row for each document that loses nothing."""

    def run(batches: Iterator[pa.RecordBatch]):
        for part in parts(batches, 1):
            scan = Scan(part.column(1))
            begins, ends, bounds = scan.words()
            left = kept_texts(scan, begins, ends, bounds, np.ones(len(begins), bool))
            none, one = np.zeros(part.num_rows, np.int64), np.ones(part.num_rows, np.int64)
            yield _result(names, part.column(0), part.column(1), make, left, np.diff(bounds), none, one)

    return run


def _pack(batches: Iterator[pa.RecordBatch]):
    """One row (doc, runs) for each batch and document: its passages as they are, not united."""
    for batch in batches:
        if batch.num_rows:
            doc, first, last = _columns(batch)
            cuts = np.append(np.flatnonzero(_changes(doc)), len(doc))
            pairs = np.stack([first, last], axis=1).astype("<i8")
            packed = [pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[cuts[:-1]]), pa.array(packed, pa.binary())], names=["doc", "runs"]
            )


def located(docs: DataFrame, id_col: str, text: str, make, schema: str) -> DataFrame:
    """A row for each document: doc, and what ``make`` returns of its text, the kept words joined by
    one space, and the numbers of words and of removed words."""
    scratch = Scratch(docs.sparkSession)
    given = docs.select(quoted(id_col).cast("bigint").alias("doc"), quoted(text).alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("doc"), F.lit(max(1, -(-size // SHARD_BYTES))))
    usable = given.where("doc is not null and text is not null").select(
        F.xxhash64("doc", "text").alias("hash"), "doc", "text"
    )
    rest = given.where("doc is null or text is null")
    combined = usable.mapInArrow(combine_repeats, REPEATS_SCHEMA)
    combined = combined.withColumnRenamed("hash", "doc").withColumn("shard", shard)
    usable = usable.select(F.col("hash").alias("doc"), "text").withColumn("shard", shard)
    anchors = usable.select("doc", "shard", "text").mapInArrow(_anchor_rows, ANCHOR_SCHEMA)
    by_key = anchors.repartition("key").sortWithinPartitions("key", "context", "shard")
    confirmed = scratch.put("confirmed", by_key.mapInArrow(_confirm, PASSAGE_SCHEMA))
    open_ranges = runs_by_doc(confirmed.where("open"))
    # Merged at every size, so that the cost grows evenly with the input.
    once = combined.where("text is not null").select("doc", "text")
    pairs = once.hint("merge").join(open_ranges, "doc").select("doc", "text", "runs")
    by_pair = (
        pairs.mapInArrow(_pair_rows, "a bigint, b bigint, doc bigint, at bigint")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b")
    )
    windows = scratch.put("windows", by_pair.mapInArrow(_recurring, PASSAGE_SCHEMA))
    passages = confirmed.where("not open").unionAll(windows).select("doc", "first", "last")
    packed = (
        passages.repartition("doc")
        .sortWithinPartitions("doc", "first", "last")
        .mapInArrow(_pack, "doc bigint, runs binary")
        .withColumn("shard", shard)
    )
    columns = "shard", "doc", "id", "text", "copies"
    rows = combined.select(*columns, F.lit(None).cast("binary").alias("runs")).unionByName(
        packed, allowMissingColumns=True
    )
    names = [*(c.split()[0] for c in schema.split(", ")), "copies"]
    schema += ", copies bigint"
    dealt = rows.repartition("shard").sortWithinPartitions("shard")
    out = dealt.mapInArrow(_stream(make, names), schema)
    out = out.unionAll(rest.mapInArrow(_whole(make, names), schema))
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return out.select("*", each.alias("copy")).drop("copies", "copy")


def _digest(text, kept: bytes, n_words: int, n_removed: int):
    return n_words, n_removed, hashlib.sha256(kept).hexdigest()


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and text of every row, the words that are left joined by one space where any have gone."""

    def make(value, kept, n_words, n_removed):
        return (kept.decode() if n_removed else value.as_py(),)

    out = located(docs, id_col, text, make, "doc bigint, text string")
    return out.toDF(id_col, text)


def op3_phrase_automata(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return located(docs, "doc_id", "text", _digest, schema)
