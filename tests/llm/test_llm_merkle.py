"""The Merkle manifest against a plain one in memory."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from messy import documents, empty, rows
from pyspark.sql import functions as F

from tradewind.llm import merkle_manifest
from tradewind.llm.merkle_manifest import FIELDS


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    parts = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row]
    return digest("".join(parts))


def tree(leaves):
    """The levels of a tree from its leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[k : k + 2])) for k in range(0, len(below), 2)])
    return levels


def path(levels, place):
    """Per level what stands before and after a node's ancestor in its run."""
    out = []
    for level in levels[:-1]:
        run = place // 2 * 2
        out.append((level[run:place], level[place + 1 : run + 2]))
        place //= 2
    return out


def brute(given):
    """Expected rows of the query, from rows of FIELDS."""
    groups = defaultdict(list)
    for row in given:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, (g, levels) in enumerate(zip(order, trees, strict=True)):
        for place, (_, _, own, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = path(levels, place) + path(top, k)
            proof = digest("".join("".join(before + after) for before, after in steps))
            now = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                now = leaf((*row[:3], row[3] + 1, *row[4:]))
            for before, after in steps:
                now = digest("".join([*before, now, *after]))
            root = top[-1][0]
            out.append((row[0], own, levels[-1][0], root, proof, now, now == root))
    return sorted(out, key=repr)


def table_of(given):
    """Rows of FIELDS from rows of (doc_id, text, lang, source)."""
    return [(i, source, lang, None if t is None else len(t), t) for i, t, lang, source in given]


@pytest.mark.parametrize("band", [10, 1, 3])
def test_query_equals_a_plain_tree(spark, tmp_path, monkeypatch, band):
    monkeypatch.setattr(merkle_manifest, "BAND", band)
    given = rows()
    given += [(None, "x", "en", None), (None, "x", "en", None), (7, "é🙂", "", "s"), (8, None, "zz", "s"), (9, "y", "ä", "s")]
    given += [(500, "hot", "en", "s")] * 40
    documents(spark, given).write.parquet(str(tmp_path / "documents.parquet"))
    got = merkle_manifest.op12_merkle_manifest(spark, str(tmp_path))
    expected = brute(table_of(given))
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert {r[-1] for r in expected} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 17])
def test_sizes(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(merkle_manifest, "BAND", 2)
    given = [(k, f"t{k}", None, "s") for k in range(n)]
    documents(spark, given, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = merkle_manifest.op12_merkle_manifest(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(table_of(given))


def test_empty(spark, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert merkle_manifest.op12_merkle_manifest(spark, str(tmp_path)).count() == 0


def test_manifest_of_other_columns(spark):
    df = spark.range(50).select(
        (F.col("id") % 3).alias("grp"), F.col("id").alias("key"), F.lit("x").alias("digest"), F.lit(1).alias("place")
    )
    found = merkle_manifest.manifest(
        df, merkle_manifest.leaf(F.col("key"), F.col("digest")), F.col("grp"), F.col("key"),
        {"key": F.col("key"), "proof of": F.col("place")},
    )
    assert found.columns == ["key", "proof of", "leaf", "subroot", "root", "place", "proof"]
    right = merkle_manifest.fold(F.col("leaf"), F.col("proof")) == F.col("root")
    wrong = merkle_manifest.fold(F.sha2("leaf", 256), F.col("proof")) == F.col("root")
    assert found.where(right & ~wrong).count() == 50
    assert {(r.key // 3, r.place) for r in found.collect()} == {(k, k) for k in range(17)}


def test_messages_come_in_order_of_labels():
    rng = random.Random(1)
    for n in (1, 2, 7, 16):
        digests = [digest(str(rng.random())) for _ in range(n)]
        levels = tree(digests)
        nodes = merkle_manifest.rise([d.encode() for d in digests], len(levels) - 1)
        assert nodes == {(h, k): d.encode() for h, level in enumerate(levels) for k, d in enumerate(level)}
        proofs = merkle_manifest.sink(nodes, len(levels) - 1, ["above"])
        for place, steps in enumerate(proofs):
            expected = [f"<{b[0]}" if b else f">{a[0]}" if a else "" for b, a in path(levels, place)]
            assert steps == [*expected, "above"]


def test_fields():
    assert leaf((12, None, "é", 3, "ab")) == digest("2:12-2:é1:32:ab")
    assert FIELDS == ("doc_id", "source", "lang", "n_chars", "text")
