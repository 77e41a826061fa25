"""Jaccard join over word n-grams with Bayesian candidate pruning.

A document is the set of its five-word shingles. Equal sets are handled as one class. MinHash bands bring
classes together; inside a band's bucket, signatures are compared a few values at a time, and a pair is
dropped as soon as the posterior probability (uniform prior) that its similarity reaches the threshold
is below the tolerance. Classes that hang together by surviving pairs make a cluster, and inside a
cluster all pairs are verified exactly on their shingles, by products of sparse blocks.

A bucket or cluster of any size is cut into blocks whose pairs are spread over tasks. Inside a bucket only
what connects classes is looked for: a class that is connected already is not compared again. Tasks
return a row per class with its number of links and the smallest document it hangs together with, never
a row per pair. Nothing is capped.

Two sets of similarity 0.8 share no band with a probability of 1e-10, and are dropped wrongly with one of
1e-6 at most for each comparison.

Defined results: a document of one to four words has one shingle, its words; a document without words
(null or empty text) and a row without an id link with nothing. Rows of equal id share a class id
and their links. An empty table gives no rows. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import Scratch, giving_back, quoted, table
from tradewind.llm.components import components
from tradewind.llm.textscan import (
    REMEMBERED, REPEATS_SCHEMA, Scan, combine_repeats, mix, parts, word_windows,
)

WORDS = 5
MIN_JACCARD = 0.8
TOLERANCE = 1e-6
#: MinHash values in bands of three.
BANDS, ROWS = 32, 3
HASHES = BANDS * ROWS
#: Values compared before each look at the posterior.
STEP = 16
#: Classes of a bucket or cluster, and their shingles, that one task has as one block.
BLOCK, BLOCK_SHINGLES = 256, 1 << 19

_rng = np.random.default_rng(77)
MULTIPLIERS = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2)) + np.uint32(1)
OFFSETS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def least_matches(threshold: float = MIN_JACCARD, tolerance: float = TOLERANCE) -> list[int]:
    """After each step, the fewest equal values with which a pair is still carried on.

    With m of n values equal, the similarity's posterior is Beta(m + 1, n - m + 1), whose upper tail is
    that of a binomial distribution.
    """
    least = []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return least


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    scan = Scan(texts)
    begins, ends, bounds = scan.words()
    words = mix(scan.hashes(begins, ends))
    windows, first = word_windows(words, bounds, WORDS)
    cuts = np.searchsorted(first, bounds)
    out = []
    for k in range(len(texts)):
        n = bounds[k + 1] - bounds[k]
        if n >= WORDS:
            out.append(np.unique(windows[cuts[k] : cuts[k + 1]]))
        elif n:
            few = words[bounds[k] : bounds[k + 1]]
            total = np.uint64(n)
            for w in few:
                total = mix(np.array([total ^ w], np.uint64))[0]
            out.append(np.array([total], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, of which 32 bits are hashed and 16 are kept."""
    narrow = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(narrow), 2048):
        part = MULTIPLIERS[:, None] * narrow[None, start : start + 2048] + OFFSETS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    # The smallest values have empty high bits, so all bits are mixed before cutting.
    return (mix(least.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


@giving_back
def _sign(batches: Iterator[pa.RecordBatch]):
    for part in parts(batches, 1):
        sets = shingle_sets(part.column(1))
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            names=["id", "digest", "n", "signature"],
        )


@giving_back
def _bands(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        node, signatures = batch.column(0), _matrix(batch.column(1), np.uint16)
        values = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
        keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), 1))
        for k in range(ROWS):
            keys = mix(keys ^ (values[:, :, k] + np.uint64(0x9E3779B97F4A7C15)))
        which = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.reshape(-1).view(np.int64)), node.take(which)], names=["key", "node"]
        )


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _units(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]):
    """The rows of each unit; units come one after the other, and hold two blocks at most."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        part = part if held is None else pa.concat_tables([held, part]).combine_chunks()
        new = np.zeros(part.num_rows, bool)
        new[0] = True
        for k in keys:
            values = part.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        for begin, end in zip(starts[:-1], starts[1:], strict=True):
            if end - begin > 1:
                yield part.slice(begin, end - begin)
        held = part.slice(starts[-1])
    if held is not None and held.num_rows > 1:
        yield held


class _Forest:
    """Which rows hang together; roots are rows of the smallest node."""

    def __init__(self, node: np.ndarray):
        self.node, self.root = node, list(range(len(node)))

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            if self.node[i] > self.node[j]:
                i, j = j, i
            self.root[j] = i


def _connect(least: list[int]):
    """(node, root) of the classes that surviving pairs connect, by bucket."""

    def survivors(one: np.ndarray, others: np.ndarray) -> np.ndarray:
        alive, equal = np.arange(len(others)), np.zeros(len(others), np.int64)
        for k, needed in enumerate(least):
            a = slice(k * STEP, (k + 1) * STEP)
            equal = equal + (others[alive, a] == one[a]).sum(axis=1)
            keep = equal >= needed
            alive, equal = alive[keep], equal[keep]
            if not len(alive):
                break
        return alive

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]):
        nodes, roots = [], []
        for unit in _units(batches, ("key", "low", "high")):
            node = unit.column("node").to_numpy()
            block = unit.column("block").to_numpy()
            signatures = _matrix(unit.column("signature").combine_chunks(), np.uint16)
            apart = unit.column("low")[0] != unit.column("high")[0]
            forest = _Forest(node)
            # Breadth first; what has been reached is not compared again.
            free = np.arange(len(node))
            while len(free):
                front, free = [free[0]], free[1:]
                while front and len(free):
                    one = front.pop()
                    if apart:
                        other = block[free] != block[one]
                        near = free[other][survivors(signatures[one], signatures[free[other]])]
                    else:
                        near = free[survivors(signatures[one], signatures[free])]
                    for x in near.tolist():
                        forest.join(one, x)
                    front.extend(near.tolist())
                    free = np.setdiff1d(free, near, assume_unique=True)
            for i in range(len(node)):
                root = forest.find(i)
                if root != i:
                    nodes.append(node[i])
                    roots.append(node[root])
            if len(nodes) >= 50_000:
                yield _pairs(nodes, roots)
                nodes, roots = [], []
        yield _pairs(nodes, roots)

    return run


def _pairs(a, b):
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
    )


@giving_back
def _shingle(batches: Iterator[pa.RecordBatch]):
    """Rows of members with their shingles, where the text is the class's own.

    Rows come sorted by node; what repeats one is left out.
    """
    last, seen = None, set()
    for part in parts(batches, 0):
        sets = shingle_sets(part.column(0))
        right = [digest(s) == d for s, d in zip(sets, part.column(1).to_pylist(), strict=True)]
        nodes = part.column(part.schema.get_field_index("node")).to_pylist()
        for k, (node, d) in enumerate(zip(nodes, part.column(1).to_pylist(), strict=True)):
            if node != last or len(seen) > REMEMBERED:
                last, seen = node, set()
            if right[k]:
                right[k] = d not in seen
                seen.add(d)
        at = pa.array(np.flatnonzero(right))
        columns = [part.column(i).take(at) for i in range(2, part.num_columns)]
        packed = [s.tobytes() for s, x in zip(sets, right, strict=True) if x]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(packed, pa.binary())], names=[*part.schema.names[2:], "shingles"]
        )


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values the sets of ``left`` share with those of ``right``, exactly."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    # What only one set has is in no intersection.
    shared = counts[column] > 1
    column, owner = (np.cumsum(counts > 1) - 1)[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    place = np.full(len(sets), -1)
    place[left] = np.arange(len(left))
    total = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        dense = np.zeros((len(sets), width), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        total += dense[left] @ dense[right].T
    return total


def _verify(min_jaccard: float):
    """(node, links, root) of the members of each cluster."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]):
        for unit in _units(batches, ("cluster", "low", "high")):
            # A class that several tasks have sent.
            first = {}
            names = ("node", "shingles")
            for k, x in enumerate(zip(*(unit.column(c).to_pylist() for c in names), strict=True)):
                first.setdefault(x, k)
            if len(first) < unit.num_rows:
                unit = unit.take(pa.array(list(first.values())))
            node, copies, block = (
                unit.column(c).to_numpy() for c in ("node", "copies", "block")
            )
            sets = [np.frombuffer(x, np.uint64) for x in unit.column("shingles").to_pylist()]
            size = np.array([len(s) for s in sets])
            low, high = unit.column("low")[0].as_py(), unit.column("high")[0].as_py()
            everyone = np.arange(len(node))
            right = everyone if low == high else np.flatnonzero(block == high)
            lefts = everyone if low == high else np.flatnonzero(block == low)
            links, forest = np.zeros(len(node), np.int64), _Forest(node)
            for start in range(0, len(lefts), BLOCK):
                left = lefts[start : start + BLOCK]
                common = common_counts(sets, left, right)
                union = size[left][:, None] + size[right][None, :] - common
                near = common >= min_jaccard * union - 1e-9
                if low == high:
                    near &= left[:, None] < right[None, :]
                i, j = np.nonzero(near)
                i, j = left[i], right[j]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    forest.join(x, y)
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[linked]),
                    pa.array(links[linked]),
                    pa.array(node[[forest.find(x) for x in linked]].astype(np.int64)),
                ],
                names=["node", "links", "root"],
            )

    return run


def _in_blocks(rows: DataFrame, by: str, blocks) -> DataFrame:
    """Rows once for each pair of blocks that they are part of, dealt out and sorted by unit."""
    rows = rows.withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    ).drop("blocks", "other", "size", "weight")
    return rows.repartition(by, "low", "high").sortWithinPartitions(by, "low", "high")


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_jaccard: float = MIN_JACCARD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: id, class_id (smallest id it hangs together with) and n_links."""
    scratch = Scratch(docs.sparkSession)
    given = docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text).alias("text"))
    signed = scratch.put(
        "signed", given.mapInArrow(_sign, "id bigint, digest binary, n int, signature binary")
    )
    linkable = signed.where("id is not null and digest is not null")
    classes = scratch.put(
        "classes",
        linkable.groupBy("digest").agg(
            F.min("id").alias("node"), F.count("*").alias("copies"),
            F.first("n").alias("n"), F.first("signature").alias("signature"),
        ),
    )
    # Most classes share no band with any other; their signatures are not moved.
    keys = classes.select("node", "signature").mapInArrow(_bands, "key bigint, node bigint")
    shared = scratch.put(
        "shared", keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    )
    bucketed = keys.join(shared, "key").join(classes.select("node", "signature"), "node")
    blocks = F.ceil(F.col("size") / (BLOCK * 4)).cast("int")
    edges = _in_blocks(bucketed, "key", blocks).mapInArrow(
        _connect(least_matches(min_jaccard, tolerance)), "a bigint, b bigint"
    )
    clusters = components(edges, scratch, "clusters")
    members = scratch.put(
        "members",
        clusters.join(classes.select("node", "copies", "n", "digest"), "node").select(
            "digest", F.col("root").alias("cluster"), "node", "copies", "n"
        ),
    )
    sizes = members.groupBy("cluster").agg(
        F.count("*").alias("size"), F.sum("n").alias("weight")
    )
    members = members.join(sizes, "cluster")
    # A class stands for its repeated rows, so few of them are moved and one is verified.
    once = given.where("id is not null and text is not null").select(
        F.xxhash64("id", "text").alias("hash"), "id", "text"
    )
    once = once.mapInArrow(giving_back(combine_repeats), REPEATS_SCHEMA).where("text is not null")
    once = once.select("id", "text")
    # Sorted and merged at every size, so that the cost grows evenly with the input.
    texts = once.hint("merge").join(members, once["id"] == members["node"]).select(
        "text", "digest", "cluster", "node", "copies", "size", "weight"
    )
    shingled = texts.mapInArrow(
        _shingle,
        "cluster bigint, node bigint, copies bigint, size bigint, weight bigint, shingles binary",
    )
    blocks = F.greatest(
        F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)
    ).cast("int")
    links = scratch.put(
        "links",
        _in_blocks(shingled, "cluster", blocks).mapInArrow(
            _verify(min_jaccard), "node bigint, links bigint, root bigint"
        ),
    )
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    linked = links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(linked, scratch, "linked")
    per_class = (
        classes.select("digest", "node", "copies")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("digest", "node", "copies", "links", "root")
    )
    joined = linkable.select("id", "digest").join(per_class, "digest").select(
        "id",
        F.coalesce("root", "node").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    alone = signed.where("id is null or digest is null").select(
        "id", F.col("id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links")
    )
    return joined.unionAll(alone).withColumnRenamed("id", id_col)


def op8_ngram_join(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents"))


def stage(spark, docs, sf_dir):
    """One document of each group stays, the one with the smallest id."""
    judged = jaccard_join(docs)
    gone = judged.where("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[quoted(c) for c in docs.columns])
