"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Every table sorts the vectors along a random direction, inside cells given by the signs of a few
other directions. Two vectors collide in a table if they share its cell and lie within a window
centred on either. From the least cosine that counts follows the probability of a collision, and
from it the number of tables and the least count of collisions that keep the wanted share of all such
pairs. Pairs with that count are verified by their cosine in double precision.

The number of sign bits grows with the logarithm of the number of vectors, so that a cell holds a
bounded number of unrelated ones and the work grows far slower than with the square. A cell with many
vectors is cut into blocks whose pairs are spread over tasks. A pair is handled only in the first
table in which it collides: every task computes all projections of its vectors anew, on whole numbers,
so that all tasks agree. What leaves a task is a row per vector with its number of links and the
smallest vector that it hangs together with there, never a row per pair.

Defined results: vectors that are null, of length zero, or hold null or non-finite components, and rows
without an id, link with nothing; vectors of different dimensions do not either. Equal vectors are
handled as one and link with each other. Rows of equal id share a component and their links.
An empty table gives no rows. Only the id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import Scratch, quoted, table
from tradewind.llm.components import components

MIN_COSINE = 0.9
RECALL = 0.9995
#: Half the window, in standard deviations of the projected distance at the least cosine.
WINDOW = 2.5
#: Vectors that a cell should hold besides near-duplicates.
PER_CELL = 64
#: Collisions expected of a pair at the least cosine.
COLLISIONS = 10
#: Vectors of a cell that one task compares with each other.
BLOCK = 2048
#: Vectors are rounded to this many steps a unit, directions to the second; sums stay exact.
VECTOR_STEPS, DIRECTION_STEPS = 1 << 20, 1 << 10
PAIRS_AT_ONCE = 20_000


@dataclass(frozen=True)
class Scheme:
    """Tables, sign bits of a cell, window and least count for a number of vectors."""

    bits: int
    tables: int
    window: float
    least_count: int
    min_cosine: float
    seed: int

    @classmethod
    def calibrated(cls, n: int, min_cosine=MIN_COSINE, recall=RECALL, seed=11) -> Scheme:
        bits = max(0, round(math.log2(max(n, 1) / PER_CELL)))
        same_sign = 1 - math.acos(min_cosine) / math.pi
        p = same_sign**bits * math.erf(WINDOW / math.sqrt(2))
        tables = max(8, math.ceil(COLLISIONS / p))
        # The largest count that pairs at the least cosine reach with the wanted probability.
        term = below = (1 - p) ** tables
        least = 1
        while least < tables:
            term *= (tables - least + 1) / least * p / (1 - p)
            if 1 - (below + term) < recall:
                break
            below += term
            least += 1
        window = WINDOW * math.sqrt(2 - 2 * min_cosine)
        return cls(bits, tables, window, least, min_cosine, seed)


class Projector:
    """Cells and places of vectors in all tables."""

    def __init__(self, scheme: Scheme, dimensions: int):
        rng = np.random.default_rng([scheme.seed, dimensions, scheme.bits, scheme.tables])
        shape = (dimensions, scheme.tables * (scheme.bits + 1))
        self.directions = np.rint(rng.standard_normal(shape) * DIRECTION_STEPS)
        self.scheme = scheme
        self.weights = 1 << np.arange(scheme.bits, dtype=np.int64)

    def __call__(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cells, places), each of shape (vectors, tables)."""
        s = self.scheme
        # Whole numbers below 2**53: the sums are exact, in whatever order they are made.
        whole = np.rint(unit * VECTOR_STEPS) @ self.directions
        whole = whole.reshape(len(unit), s.tables, s.bits + 1)
        cells = (whole[:, :, 1:] > 0) @ self.weights if s.bits else np.zeros(whole.shape[:2], int)
        return cells, whole[:, :, 0] / (VECTOR_STEPS * DIRECTION_STEPS)


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """Vectors of one length from binary values."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    # Scaled first, so that squares neither vanish nor overflow.
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _emit(scheme: Scheme, dtype: str, payload: bool):
    """A row for each vector and table; with the vector only if it is asked for."""

    def run(batches: Iterator[pa.RecordBatch]):
        projectors: dict[int, Projector] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                node = batch.column(0).to_numpy()
                copies = batch.column(1).to_numpy()
                lengths = np.array([len(x) for x in batch.column(2).to_pylist()])
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    raw = batch.column(2).take(pa.array(at))
                    vectors = np.array(raw.to_pylist(), dtype)
                    projector = projectors.setdefault(length, Projector(scheme, int(length)))
                    cells, _ = projector(_unit(vectors))
                    n = len(at)
                    out = {
                        "d": np.full(n * scheme.tables, length, np.int32),
                        "t": np.tile(np.arange(scheme.tables, dtype=np.int32), n),
                        "cell": cells.reshape(-1),
                    }
                    if payload:
                        out["node"] = np.repeat(node[at], scheme.tables)
                        out["copies"] = np.repeat(copies[at], scheme.tables)
                        packed = pa.array([v.tobytes() for v in vectors], pa.binary())
                        which = np.repeat(np.arange(n), scheme.tables)
                        out["vector"] = packed.take(pa.array(which))
                    yield pa.RecordBatch.from_pydict(out)

    return run


KEYS = ("d", "t", "cell", "low", "high")


def _compare(scheme: Scheme, dtype: str):
    """Links inside each unit of rows that come one after the other."""

    def links_of(t, low, high, block, node, copies, unit, cells, places):
        order = np.argsort(places[:, t], kind="stable")
        line = places[order, t]
        until = np.searchsorted(line, line + scheme.window, "right")
        widths = until - np.arange(len(line)) - 1
        count, root = np.zeros(len(line), np.int64), np.arange(len(line))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        done = 0
        while done < len(line):
            # As many query rows as make a bounded number of pairs, one at least.
            total = np.cumsum(widths[done:])
            stop = done + max(1, int(np.searchsorted(total, PAIRS_AT_ONCE, "right")))
            w = widths[done:stop]
            i = np.repeat(np.arange(done, stop), w)
            j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + i + 1
            done = stop
            i, j = order[i], order[j]
            if low != high:
                apart = block[i] != block[j]
                i, j = i[apart], j[apart]
            for begin in range(0, len(i), PAIRS_AT_ONCE):
                a, b = i[begin : begin + PAIRS_AT_ONCE], j[begin : begin + PAIRS_AT_ONCE]
                hit = cells[a] == cells[b]
                hit &= np.abs(places[a] - places[b]) <= scheme.window
                # Counted where the pair collides first, and nowhere else.
                mine = (hit.argmax(axis=1) == t) & (hit.sum(axis=1) >= scheme.least_count)
                a, b = a[mine], b[mine]
                near = (unit[a] * unit[b]).sum(axis=1) >= scheme.min_cosine
                a, b = a[near], b[near]
                np.add.at(count, a, copies[b])
                np.add.at(count, b, copies[a])
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    x, y = find(x), find(y)
                    if x != y:
                        if node[x] > node[y]:
                            x, y = y, x
                        root[y] = x
        linked = np.flatnonzero(count)
        return node[linked], count[linked], node[[find(x) for x in linked]]

    def run(batches: Iterator[pa.RecordBatch]):
        projectors: dict[int, Projector] = {}

        def links(part: pa.Table):
            """Complete units only; those of a single row are left out before any work."""
            keys = [part.column(k).to_numpy() for k in KEYS]
            new = np.zeros(part.num_rows, bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            starts = np.append(np.flatnonzero(new), part.num_rows)
            sizes = np.diff(starts)
            found = []
            for d in np.unique(keys[0]):
                at = np.flatnonzero((sizes > 1) & (keys[0][starts[:-1]] == d))
                rows = np.concatenate([np.arange(starts[x], starts[x + 1]) for x in at] or [[]])
                if not len(rows):
                    continue
                taken = part.take(pa.array(rows, pa.int64()))
                vectors = _matrix(taken.column("vector").combine_chunks(), dtype)
                unit = _unit(vectors)
                projector = projectors.setdefault(d, Projector(scheme, int(d)))
                cells, places = projector(unit)
                node, copies, block = (taken.column(c).to_numpy() for c in ("node", "copies", "block"))
                ends = np.cumsum(sizes[at])
                for x, begin, end in zip(at, ends - sizes[at], ends, strict=True):
                    s, first = slice(begin, end), starts[x]
                    found.append(
                        links_of(
                            keys[1][first], keys[3][first], keys[4][first], block[s], node[s],
                            copies[s], unit[s], cells[s], places[s],
                        )
                    )
            names = ["node", "links", "root"]
            columns = [np.concatenate([f[i] for f in found] or [[]]).astype("i8") for i in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part]).combine_chunks()
            # The last unit may go on in the next batch; it has two blocks at most.
            last = np.ones(part.num_rows, bool)
            for k in KEYS:
                values = part.column(k).to_numpy()
                last &= values == values[-1]
            begin = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if begin:
                yield links(part.slice(0, begin))
            held = part.slice(begin)
        if held is not None:
            yield links(held)

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
    min_cosine: float = MIN_COSINE, recall: float = RECALL,
) -> DataFrame:
    """One row per input row: id, n_links and component_id, the smallest id it hangs together with."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    given = vectors.select(quoted(id_col).cast("bigint").alias("id"), quoted(vector).alias("v"))
    double = "double" in given.schema["v"].dataType.simpleString()
    dtype = "<f8" if double else "<f4"
    linkable = given.where(F.col("id").isNotNull() & usable(F.col("v")))
    classes = scratch.put(
        "classes", linkable.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    )
    scheme = Scheme.calibrated(classes.count(), min_cosine, recall)
    narrow = classes.select("node", "copies", "v")
    keys = narrow.mapInArrow(_emit(scheme, dtype, False), "d int, t int, cell bigint")
    full = scratch.put(
        "full", keys.groupBy("d", "t", "cell").agg(F.count("*").alias("n")).where(f"n > {BLOCK}")
    )
    rows = narrow.mapInArrow(
        _emit(scheme, dtype, True),
        "d int, t int, cell bigint, node bigint, copies bigint, vector binary",
    )
    # The table of full cells is read with its size, so the planner knows how to join it.
    rows = rows.join(full, ["d", "t", "cell"], "left")
    rows = rows.withColumn("blocks", F.ceil(F.coalesce("n", F.lit(1)) / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    units = rows.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "d", "t", "cell", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"), "block", "node", "copies", "vector",
    )
    dealt = units.repartition(*KEYS).sortWithinPartitions(*KEYS)
    links = scratch.put(
        "links", dealt.mapInArrow(_compare(scheme, dtype), "node bigint, links bigint, root bigint")
    )
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    edges = links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    # Equal ids on different vectors are one vertex already.
    roots = components(edges, scratch)
    per_class = (
        classes.join(counts, "node", "left").join(roots, "node", "left")
        .select("v", "node", "copies", "links", "root")
    )
    of_row = given.where(F.col("id").isNotNull() & usable(F.col("v"))).join(per_class, "v")
    linked = of_row.select(
        "id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    alone = given.where(~(F.col("id").isNotNull() & usable(F.col("v")))).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.unionAll(alone).withColumnRenamed("id", id_col)


def op1_embedding_dups(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return out.select("vec_id", "n_links", "component_id", kept.alias("kept"))
