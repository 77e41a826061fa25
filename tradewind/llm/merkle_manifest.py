"""Merkle manifest of a dataset, by time-forward processing.

Rows become leaves; per group the leaves stand in order, and runs of two nodes become one node of the next level
until one is left, the group's subroot. The subroots, in order of their groups, become the root the same way.

Node labels are (level, place). A node's digest is a message to its parent, and messages are handled in order of
labels, as an external priority queue would hand them out: between bands of ``BAND`` levels Spark's sorted shuffle
is that queue, inside a band a heap of at most 2**BAND messages. A second sweep goes through the labels in reverse and
sends each node the siblings of all nodes above it, down to the leaves. A task holds one run of 2**BAND nodes, and a
run gets what lies above it once, not once a leaf.

Defined results: null values have a digest of their own; null groups and null keys come first. Rows of equal group,
key and digest are leaves side by side, each with its proof. A group of one leaf has that leaf as subroot, a table of one
group that subroot as root; an empty table gives no rows. Other columns than those named are ignored, so none can clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import Scratch, quoted, table

#: Levels that one step computes.
BAND = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A step of a proof begins with the side on which the sibling stands; without a sibling it is empty.
BEFORE, AFTER = "<", ">"

NODE = "grp string, place bigint, size bigint, digest string"
MESSAGE = "grp string, place bigint, subroot string, root string, proof array<string>"


def leaf(*values: Column) -> Column:
    """Digest of some values, each with its length in bytes, or a dash for null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def siblings(proof: Column) -> Column:
    """The digests of a proof, from the leaf's level to the root's."""
    return F.transform(F.filter(proof, lambda s: s != ""), lambda s: F.substr(s, F.lit(2)))


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(node: Column, step: Column) -> Column:
        sibling = F.substr(step, F.lit(2))
        before = F.concat(sibling, node)
        return F.sha2(F.when(F.startswith(step, F.lit(BEFORE)), before).otherwise(F.concat(node, sibling)), 256)

    return F.aggregate(proof, digest, up)


# --- places -----------------------------------------------------------------------


def _numbered(rows: DataFrame, by: list[str], scratch: Scratch, name: str) -> DataFrame:
    """Adds ``place``, from 0 in the order of ``by`` within ``grp``, and the group's ``size``.

    ``by`` has no ties, so that a hot key is dealt out too; no task sees more of a group than its own range.
    """
    dealt = rows.repartitionByRange("grp", *by).sortWithinPartitions("grp", *by)
    sorted_rows = scratch.put(
        name,
        dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")),
    )
    # One row per group and range.
    ranges = sorted_rows.groupBy("grp", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    ranges_before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "grp", "part",
        (F.coalesce(F.sum("n").over(ranges_before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("grp")).alias("size"),
    )
    placed = sorted_rows.join(ranges, ["grp", "part"])
    return placed.select(*rows.columns, (F.col("row") + F.col("shift")).alias("place"), "size")


# --- sweeps -----------------------------------------------------------------------


def rise(digests: list[bytes], levels: int) -> dict[tuple[int, int], bytes]:
    """The nodes over some neighbours, by label; children reach their parent through a priority queue."""
    queue = [(0, k, 0, digest) for k, digest in enumerate(digests)]
    nodes = {}
    while queue:
        level, place, _, digest = heapq.heappop(queue)
        if level:
            children = [digest]
            while queue and queue[0][:2] == (level, place):
                children.append(heapq.heappop(queue)[3])
            digest = sha256(b"".join(children)).hexdigest().encode()
        nodes[level, place] = digest
        if level < levels:
            heapq.heappush(queue, (level + 1, place >> 1, place & 1, digest))
    return nodes


def sink(nodes: dict[tuple[int, int], bytes], levels: int, above: list[str]) -> list[list[str]]:
    """Proofs of the lowest nodes in their order; parents reach their children in reverse order of labels."""
    # A proof is its first step and the proof of the parent.
    queue = [(-levels, 0, (None, None))]
    proofs = []
    while queue:
        level, place, proof = heapq.heappop(queue)
        if level == 0:
            steps = []
            while proof[1] is not None:
                steps.append(proof[0])
                proof = proof[1]
            proofs.append(steps + above)
            continue
        for child in (2 * place, 2 * place + 1):
            if (-level - 1, child) in nodes:
                sibling = nodes.get((-level - 1, child ^ 1))
                side = BEFORE if child & 1 else AFTER
                step = side + sibling.decode() if sibling else ""
                heapq.heappush(queue, (level + 1, child, (step, proof)))
    return proofs


def _levels(size: int, band: int) -> int:
    """Levels that a band has of a group with so many nodes at its foot."""
    return min(band, (size - 1).bit_length())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (group, run) after the other."""
    held, key = [], None
    for batch in batches:
        keys = list(zip(batch.column("grp").to_pylist(), batch.column("run").to_pylist(), strict=True))
        start = 0
        for at, found in enumerate(keys):
            if found != key:
                held.append(batch.slice(start, at - start))
                if any(map(len, held)):
                    yield pa.Table.from_batches(held)
                held, start, key = [], at, found
        held.append(batch.slice(start))
    if any(map(len, held)):
        yield pa.Table.from_batches(held)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "run").sortWithinPartitions("grp", "run", F.col("place").asc_nulls_first())


def _up(nodes: DataFrame) -> DataFrame:
    """The nodes at the head of a band, from those at its foot."""
    band = BAND

    def run(batches):
        for rows in _runs(batches):
            size = rows.column("size")[0].as_py()
            levels = _levels(size, band)
            digests = [d.encode() for d in rows.column("digest").to_pylist()]
            top = rise(digests, levels)[levels, 0].decode()
            found = rows.column("grp")[0].as_py(), rows.column("run")[0].as_py()
            yield pa.RecordBatch.from_pylist(
                [{"grp": found[0], "place": found[1], "size": -(-size >> levels), "digest": top}],
                pa.schema([("grp", pa.string()), ("place", pa.int64()), ("size", pa.int64()), ("digest", pa.string())]),
            )

    narrow = nodes.select("grp", F.shiftright("place", band).alias("run"), "place", "size", "digest")
    return _dealt(narrow).mapInArrow(run, NODE)


def _down(nodes: DataFrame, messages: DataFrame, keep: str) -> DataFrame:
    """Proofs for the nodes at the foot of a band, from the messages to those at its head.

    ``keep`` is the type of the column ``kept``, which is passed through.
    """
    band = BAND

    def run(batches):
        for rows in _runs(batches):
            # The message stands first, as it has no place.
            head, rows = rows.slice(0, 1), rows.slice(1).combine_chunks()
            levels = _levels(rows.column("size")[0].as_py(), band)
            digests = [d.encode() for d in rows.column("digest").to_pylist()]
            proofs = sink(rise(digests, levels), levels, head.column("proof")[0].as_py())
            (batch,) = rows.to_batches()
            names = ["grp", "place", "subroot", "root", "proof", "digest", "kept"]
            same = [pa.array([head.column(c)[0].as_py()] * len(rows), pa.string()) for c in ("subroot", "root")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("grp"), batch.column("place"), *same,
                    pa.array(proofs, pa.list_(pa.string())), batch.column("digest"), batch.column("kept"),
                ],
                names=names,
            )

    empty = {"size": "bigint", "digest": "string", "kept": keep}
    given = nodes.select(
        "grp", F.shiftright("place", band).alias("run"), "place", "size", "digest", "kept",
        F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"),
        F.lit(None).cast("array<string>").alias("proof"),
    )
    heads = messages.select(
        "grp", F.col("place").alias("run"), F.lit(None).cast("bigint").alias("place"),
        *[F.lit(None).cast(t).alias(c) for c, t in empty.items()], "subroot", "root", "proof",
    )
    return _dealt(given.unionByName(heads)).mapInArrow(run, f"{MESSAGE}, digest string, kept {keep}")


class _Forest:
    """The trees of some groups, band by band."""

    def __init__(self, nodes: DataFrame, scratch: Scratch, name: str):
        self.scratch, self.name = scratch, name
        if "kept" not in nodes.columns:
            nodes = nodes.withColumn("kept", F.lit(None).cast("int"))
        self.bands = [scratch.put(f"{name}-0", nodes)]
        # One number: the largest group says how many bands there are.
        size = self.bands[0].agg(F.max("size")).first()[0] or 0
        while size > 1:
            above = _up(self.bands[-1]).withColumn("kept", F.lit(None).cast("int"))
            self.bands.append(scratch.put(f"{name}-{len(self.bands)}", above))
            size = -(-size >> BAND)

    @property
    def roots(self) -> DataFrame:
        """(grp, digest) of each group."""
        return self.bands[-1].select("grp", "digest")

    def proofs(self, messages: DataFrame) -> DataFrame:
        """The leaves with their proofs, from ``messages`` to the roots."""
        for k in range(len(self.bands) - 2, -1, -1):
            nodes = self.bands[k]
            found = _down(nodes, messages, nodes.schema["kept"].dataType.simpleString())
            if k:
                messages = self.scratch.put(f"{self.name}-down-{k}", found.select(*_names(MESSAGE)))
            else:
                return found
        # All groups have one leaf.
        return self.bands[0].join(messages.drop("place"), "grp").select(
            "grp", "place", "subroot", "root", "proof", "digest", "kept"
        )


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def manifest(
    docs: DataFrame, digest: Column, group: Column, key: Column, keep: dict[str, Column] | None = None
) -> DataFrame:
    """Every row's leaf with its proof: the columns of ``keep``, then ``leaf``, ``subroot``, ``root``,
    ``place`` in its group and ``proof``, an array of steps for ``fold`` and ``siblings``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    kept = F.struct(*[c.alias(f"k{n}") for n, c in enumerate((keep or {}).values())], F.lit(0).alias("none"))
    leaves = docs.select(
        # A name for null that comes before all others.
        F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("grp"),
        key.alias("key"), digest.alias("digest"), kept.alias("kept"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # Hashed once; the numbers are settled with it.
    leaves = scratch.put("leaves", leaves)
    placed = _numbered(leaves, ["key", "digest", "tie"], scratch, "ordered")
    groups = _Forest(placed.select(*_names(NODE), "kept"), scratch, "groups")
    scratch.drop("leaves")
    subroots = groups.roots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest")
    placed = _numbered(subroots, ["key"], scratch, "subroots")
    kept_group = F.col("key").alias("kept")
    whole = _Forest(placed.select(*_names(NODE), kept_group), scratch, "whole")
    start = whole.roots.select(
        "grp", F.lit(0).cast("bigint").alias("place"), F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"), F.array().cast("array<string>").alias("proof"),
    )
    of_groups = whole.proofs(start).select(
        F.col("kept").alias("grp"), F.lit(0).cast("bigint").alias("place"),
        F.col("digest").alias("subroot"), "root", "proof",
    )
    found = groups.proofs(scratch.put("of-groups", of_groups))
    return found.select(
        *[F.col(f"kept.k{n}").alias(c) for n, c in enumerate(keep or {})],
        F.col("digest").alias("leaf"), "subroot", "root", "place", "proof",
    )


def op12_merkle_manifest(spark, sf_dir):
    """The manifest of ``documents``, checked against rows of which some were tampered with."""
    docs = table(spark, sf_dir, "documents")
    fields = {c: quoted(c) for c in FIELDS}
    checksum = F.crc32(fields["doc_id"].cast("string"))
    more = {**fields, "n_chars": fields["n_chars"].cast("decimal(20,0)") + 1}
    tampered = F.when(checksum % 7 == 0, leaf(*more.values()))
    found = manifest(
        docs, leaf(*fields.values()), fields["lang"], fields["doc_id"],
        {"doc_id": fields["doc_id"], "tampered": tampered},
    )
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    proof = F.sha2(F.array_join(siblings(F.col("proof")), ""), 256)
    found = found.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length({x}) + 1),
    lambda i: list_prepend(CAST(ord({x}[i]) AS BIGINT), list_transform(range(8), lambda j: CAST(-1 AS BIGINT)))))),
  lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
    WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END))"""

_FIELD = "coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"
_LEAF = " || ".join(_FIELD.format(x=c) for c in FIELDS)

ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, sha256({_LEAF}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC.format(x="CAST(doc_id AS VARCHAR)")} % 7 = 0
      THEN sha256({_LEAF.replace("n_chars", "(n_chars + 1)")}) ELSE sha256({_LEAF}) END AS given
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
low AS (
  SELECT 0 AS level, grp, place, leaf AS digest, count(*) OVER (PARTITION BY grp) AS size FROM placed
  UNION ALL
  SELECT level + 1, grp, place // 2, sha256(string_agg(digest, '' ORDER BY place)), any_value((size + 1) // 2)
  FROM low WHERE size > 1 GROUP BY level, grp, place // 2),
subroots AS (
  SELECT grp, digest, level, row_number() OVER (ORDER BY grp) - 1 AS place FROM low WHERE size = 1),
high AS (
  SELECT 0 AS level, place, digest, count(*) OVER () AS size FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), any_value((size + 1) // 2)
  FROM high WHERE size > 1 GROUP BY level, place // 2),
path AS (
  SELECT grp, place, place AS leaf_place, level, size > 1 AS up FROM low WHERE level = 0
  UNION ALL
  SELECT p.grp, p.place // 2, leaf_place, p.level + 1, n.size > 1
  FROM path p JOIN low n ON n.grp = p.grp AND n.level = p.level + 1 AND n.place = p.place // 2 WHERE up),
path_high AS (
  SELECT place, place AS group_place, level, size > 1 AS up FROM high WHERE level = 0
  UNION ALL
  SELECT p.place // 2, group_place, p.level + 1, n.size > 1
  FROM path_high p JOIN high n ON n.level = p.level + 1 AND n.place = p.place // 2 WHERE up),
steps AS (
  SELECT p.grp, p.leaf_place, p.level, p.place % 2 AS side, s.digest AS sibling
  FROM path p LEFT JOIN low s ON s.grp = p.grp AND s.level = p.level AND s.place = xor(p.place, 1) WHERE p.up
  UNION ALL
  SELECT l.grp, l.place, g.level + p.level, p.place % 2, s.digest
  FROM placed l JOIN subroots g ON g.grp = l.grp JOIN path_high p ON p.group_place = g.place AND p.up
  LEFT JOIN high s ON s.level = p.level AND s.place = xor(p.place, 1)),
folded AS (
  SELECT grp, place, 0 AS level, given AS digest FROM placed
  UNION ALL
  SELECT f.grp, f.place, f.level + 1, sha256(CASE WHEN sibling IS NULL THEN f.digest
    WHEN side = 1 THEN sibling || f.digest ELSE f.digest || sibling END)
  FROM folded f JOIN steps s ON s.grp = f.grp AND s.leaf_place = f.place AND s.level = f.level),
proofs AS (
  SELECT grp, leaf_place AS place, string_agg(sibling, '' ORDER BY level) AS proof FROM steps GROUP BY 1, 2)
SELECT l.doc_id, l.leaf, g.digest AS subroot, r.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = r.digest AS verified
FROM placed l JOIN subroots g ON g.grp = l.grp
JOIN (SELECT digest FROM high WHERE size = 1) r ON true
JOIN (SELECT grp, place, arg_max(digest, level) AS digest FROM folded GROUP BY 1, 2) f
  ON f.grp = l.grp AND f.place = l.place
LEFT JOIN proofs p ON p.grp = l.grp AND p.place = l.place"""
