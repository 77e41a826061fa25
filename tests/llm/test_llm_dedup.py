"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from messy import documents, empty, prose, rows

from tradewind.llm import anchors, embedding_dups, ngram_join, phrase_automata, suffix_dedup, textscan
from tradewind.llm.common import Scratch
from tradewind.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def component_of(links):
    """Smallest reachable node of every node."""
    found = {}
    for start in sorted(links):
        stack = [start]
        while stack:
            node = stack.pop()
            if node not in found:
                found[node] = start
                stack.extend(links[node])
    return found


# --- components ----------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)]
    edges += [(100 + k, 101 + k) for k in range(30)] + [(5, 5), (None, 3), edges[0]]
    rng.shuffle(edges)
    links = defaultdict(set)
    for a, b in edges:
        if a is not None:
            links[a].add(b)
            links[b].add(a)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df, Scratch(spark)).collect()}
    assert got == component_of(links)


def test_no_components(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark)).count() == 0


# --- vectors ---------------------------------------------------------------------


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((60, 16))
    near = base[:20] + rng.standard_normal((20, 16)) * 0.3
    hot = base[0] + rng.standard_normal((40, 16)) * 0.05
    data = np.concatenate([base, near, hot, base[:3]]).astype(np.float32)
    out = [(k, v.tolist()) for k, v in enumerate(data)]
    zero, nan = [0.0] * 16, [float("nan")] * 16
    odd = [None, [], zero, nan, [None] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0], [1.0, 0.0]]
    out += [(200 + k, v) for k, v in enumerate(odd)]
    return out + [(None, data[0].tolist())]


def brute_vectors(given):
    usable = {
        i: np.array(v, float)
        for i, v in given
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    }
    links = {i: set() for i, _ in given}
    for a, x in usable.items():
        for b, y in usable.items():
            if a != b and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                    links[a].add(b)
    root = component_of({i: s for i, s in links.items() if i is not None})
    return sorted(
        ((i, len(links[i]), root.get(i)) for i, _ in given), key=lambda r: (r[0] is None, r)
    )


@pytest.mark.parametrize("block", [2048, 8])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dups, "BLOCK", block)
    given = vectors()
    df = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in given], "vec_id bigint, embedding array<float>, node string, n int"
    )
    got = embedding_dups.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] is None, r)) == brute_vectors(given)


def test_vectors_empty(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_dups.near_duplicates(df).count() == 0


@pytest.mark.parametrize("n", [1, 100, 10**4, 10**7, 10**10])
def test_least_count_keeps_the_recall(n):
    s = embedding_dups.Scheme.calibrated(n)
    import math

    p = (1 - math.acos(0.9) / math.pi) ** s.bits * math.erf(embedding_dups.WINDOW / math.sqrt(2))
    missed = sum(math.comb(s.tables, k) * p**k * (1 - p) ** (s.tables - k) for k in range(s.least_count))
    assert 1 - missed >= embedding_dups.RECALL


# --- Jaccard join ----------------------------------------------------------------


def shingles(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else None


def brute_jaccard(given):
    sets = {i: shingles(t) for i, t, *_ in given}
    links = {i: Counter() for i in sets if i is not None}
    for a, x, *_ in given:
        for b, y, *_ in given:
            if None not in (a, b) and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                    links[a][b] += 1
    root = component_of(links)
    return sorted(
        (i, root[i], max(0, sum(links[i].values()) // [x[0] for x in given].count(i) - 1)) for i, *_ in given
    )


@pytest.mark.parametrize("block", [512, 3])
def test_jaccard_join(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(4)
    long = prose(rng, 120)
    hot = []
    for k in range(25):
        words = long.split(" ")
        words[4 * k] = f"other{k}"
        hot.append((500 + k, " ".join(words), "en", "src0"))
    given = rows() + hot
    got = ngram_join.jaccard_join(documents(spark, given))
    assert sorted(map(tuple, got.collect())) == brute_jaccard(given)


def test_jaccard_join_odd_ids(spark):
    given = [(None, "a b c d e f", "en", "s"), (1, "a b c d e f", "en", "s"), (2, None, "en", "s")]
    got = ngram_join.jaccard_join(documents(spark, given)).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1, 0), (2, 2, 0), (None, None, 0)]
    assert ngram_join.jaccard_join(empty(spark)).count() == 0


@pytest.mark.parametrize("remembered", [1 << 16, 0])
def test_jaccard_join_repeated_rows_with_a_near_copy(spark, monkeypatch, remembered):
    monkeypatch.setattr(textscan, "REMEMBERED", remembered)
    words = prose(random.Random(8), 120).split(" ")
    near = " ".join([*words[:60], "other", *words[61:]])
    given = [(5, " ".join(words), "en", "s")] * 2 + [(7, near, "en", "s")]
    given += [(9, near + " end", "en", "s")] * 30
    for few in (given[:3], given):
        got = ngram_join.jaccard_join(documents(spark, few)).collect()
        assert sorted(map(tuple, got)) == brute_jaccard(few)


def test_repeats_are_verified_once():
    """One row of a class is left of a task's repeats, and one of several tasks' rows."""
    import pyarrow as pa

    words = prose(random.Random(8), 60).split(" ")
    texts = [" ".join(words), " ".join([*words[:59], "other"])]
    shingled = [ngram_join.shingle_sets(pa.array([t]))[0] for t in texts]
    digests = [ngram_join.digest(s) for s in shingled]
    names = ["text", "digest", "cluster", "node", "copies"]
    rows = [(texts[0], digests[0], 1, 1, 40)] * 40 + [(texts[1], digests[1], 1, 2, 1)]
    batch = pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows, strict=True))), names=names)
    left = pa.Table.from_batches(list(ngram_join._shingle([batch, batch.slice(40)])))
    assert left.column("node").to_pylist() == [1, 2]
    both = pa.concat_tables([left, left.slice(0, 1)]).combine_chunks()
    for name in ("low", "high", "block"):
        both = both.append_column(name, pa.array([0] * 3))
    (out,) = ngram_join._verify(0.8)(both.to_batches())
    assert sorted(zip(*out.to_pydict().values(), strict=True)) == [(1, 1, 1), (2, 40, 1)]


def test_combined_repeats():
    import pyarrow as pa

    ids = pa.array([1, 1, 2, 1])
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(["a", "a", "b", "a"])], names=["h", "i", "t"])
    got = [tuple(r.values()) for b in textscan.combine_repeats([batch, batch]) for r in b.to_pylist()]
    assert got == [(1, 1, "a", 3), (2, 2, "b", 1), (1, None, None, 3), (2, None, None, 1)]


def test_jaccard_stage_keeps_one_of_each_group(spark):
    given = rows()
    docs = documents(spark, given)
    out = ngram_join.stage(spark, docs, None)
    assert out.columns == docs.columns
    roots = {i for i, root, _ in brute_jaccard(given) if i == root}
    assert {r.doc_id for r in out.select("doc_id").collect()} == roots


def test_pruning_tolerance():
    import math

    for n, needed in zip(range(16, 97, 16), ngram_join.least_matches(), strict=True):
        tail = sum(math.comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(needed))
        assert tail < 1e-6 * 1.0001


# --- passages ----------------------------------------------------------------------


def brute_words(given, size=35):
    words = [(i, WORD.findall(t or "")) for i, t, *_ in given]
    seen = Counter(tuple(w[k : k + size]) for i, w in words if i is not None for k in range(len(w) - size + 1))
    out = []
    for i, w in words:
        gone = bytearray(len(w))
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1 and i is not None:
                gone[k : k + size] = b"\1" * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


WORD_DIGEST = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


@pytest.mark.parametrize("shard", [8 << 20, 20_000])
def test_automata(spark, monkeypatch, shard):
    monkeypatch.setattr(phrase_automata, "SHARD_BYTES", shard)
    given = rows() + [(300 + k, "a b c " * 30, "en", "s") for k in range(3)]
    got = phrase_automata.located(
        documents(spark, given), "doc_id", "text", phrase_automata._digest, WORD_DIGEST
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute_words(given)


@pytest.mark.parametrize("remembered", [1 << 16, 0])
def test_automata_with_repeated_and_missing_ids(spark, monkeypatch, remembered):
    monkeypatch.setattr(textscan, "REMEMBERED", remembered)
    monkeypatch.setattr(phrase_automata, "MOST_COPIES", 4)
    monkeypatch.setattr(phrase_automata, "SHARD_BYTES", 3000)
    rng = random.Random(12)
    passage = prose(rng, 40, 5000)
    given = [(1, passage + " " + prose(rng, 60), "en", "s"), (2, prose(rng, 9) + " " + passage, "en", "s")]
    given += [(1, prose(rng, 90), "en", "s") for _ in range(9)]
    given += [(3, prose(rng, 50), "en", "s")] * 9 + [(None, passage, "en", "s")] * 5 + [(3, None, "en", "s")]
    got = phrase_automata.located(
        documents(spark, given), "doc_id", "text", phrase_automata._digest, WORD_DIGEST
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute_words(given)


def test_automata_hold_a_repeated_text_once():
    import pyarrow as pa

    names = ["shard", "doc", "id", "text", "copies", "runs"]
    columns = [[0] * 6, [7, 7, 7, 8, 7, 8], [1, 1, None, 2, None, None], ["a", "a", None, "b", None, None]]
    columns += [[2, 3, 40, 1, None, None], [None] * 4 + [b"r", b"s"]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
    ((rows, number),) = phrase_automata._shards([batch, batch.slice(0, 3)])
    assert rows.column("text").to_pylist() == ["a", "b", None, None] and number == {7: 90, 8: 1}


def test_automata_keep_texts_without_passages(spark):
    given = [(1, "only  here\n", "en", "s"), (2, "p " * 50, "en", "s"), (None, "p " * 50, "en", "s"), (3, None, "en", "s")]
    got = phrase_automata.remove_passages(documents(spark, given))
    # The repeated window is inside one document; a row without an id is left alone.
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "only  here\n"), (2, ""), (3, None), (None, "p " * 50)
    ]
    assert phrase_automata.remove_passages(empty(spark)).count() == 0


def test_locate_finds_overlapping_passages():
    # The last word agrees with another one in all that the automaton reads.
    line = np.array([1, 2, 3, 4, 5, 2, 3, 9, 2, 3 + (1 << 40)], np.uint64)
    got = phrase_automata.locate(line, np.array([0, 8, 10]), np.array([1, 2]), np.array([3, 4]))
    assert got.tolist() == [False, True, True, True, False, True, True, False, False, False]


def brute_bytes(given, size=50):
    first = {}
    for i, t, *_ in sorted((g for g in given if g[0] is not None), key=lambda g: g[0]):
        data = (t or "").encode()
        for k in range(len(data) - size + 1):
            first.setdefault(data[k : k + size], i)
    out = []
    for i, t, *_ in given:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - size + 1):
            if i is not None and first[data[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("scan", [3 << 20, 3000])
def test_suffixes(spark, monkeypatch, tmp_path, scan):
    monkeypatch.setattr(suffix_dedup, "COMBINED_BYTES", scan)
    given = rows(7)
    path = str(tmp_path / "documents.parquet")
    documents(spark, given).write.parquet(path)
    got = suffix_dedup.op9_suffix_dedup(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == brute_bytes(given)


def test_anchors_with_other_sides_go_no_further():
    """Of strings around 20 common bytes only those are open that have a side in common with another document's."""
    rng, n = np.random.default_rng(5), 40

    def some(size):
        return bytes(rng.integers(33, 127, size, dtype=np.uint8))

    grams, longer = [some(30) for _ in range(n)], [some(49) for _ in range(n)]

    def texts(common):
        return [b"".join(some(80) + c + some(80) for c in common).decode("ascii") for _ in range(2)]

    def opened(given):
        batch = pa.record_batch([pa.array([1, 2]), pa.array(given)], names=["doc", "text"])
        found = pa.Table.from_batches(suffix_dedup._anchor_rows(iter([batch])))
        found = found.sort_by([(c, "ascending") for c in ("key", "context", "doc")])
        found = pa.Table.from_batches(suffix_dedup._settle(iter(found.combine_chunks().to_batches())))
        return pc.sum(pc.cast(found["open"], pa.int64())).as_py() or 0

    # What the last key has stays open, as the next batch may have it too.
    assert opened(texts(grams)) <= 2
    assert opened(texts(longer)) >= n


@pytest.mark.parametrize("bits", [6, 7, 10])
def test_anchors_of_texts_longer_than_a_slice(monkeypatch, bits):
    rng = np.random.default_rng(bits)
    items = rng.integers(0, 5, 3000).astype(np.uint64)
    bounds = np.array([0, 1000, 1000, 1040, 3000])

    def found():
        a = anchors.Anchors(len(items), bounds, anchors.stretch_hashes(items), 50, 20)
        return [x.tolist() for x in (a.place, a.first, a.last, a.text, a.key, a.context)]

    whole = found()
    monkeypatch.setattr(anchors, "PLACE_BITS", bits)
    assert found() == whole and len(whole[0]) > 50


def test_suffix_stage_without_a_number_of_characters(spark):
    docs = documents(spark, rows(7), extra=False).drop("n_chars")
    assert suffix_dedup.stage(spark, docs, None).columns == docs.columns


def test_suffix_stage(spark):
    given = rows(7)
    docs = documents(spark, given)
    out = suffix_dedup.stage(spark, docs, None)
    assert out.columns == docs.columns and out.count() == len(given)
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert texts[next(i for i, t, *_ in given if t is None)] == (None, None)
    left = {i: h for i, *_, h in brute_bytes(given)}
    for i, (text, n) in texts.items():
        if text is not None and "�" not in text and text.isascii():
            assert hashlib.sha256(text.encode()).hexdigest() == left[i] and n == len(text)
    assert suffix_dedup.stage(spark, empty(spark), None).count() == 0


def test_one_id_with_several_texts_does_not_crash(spark):
    rng = random.Random(11)
    passage = prose(rng, 40, 5000)
    given = [(1, passage + prose(rng, 300), "en", "s"), (2, prose(rng, 90) + passage, "en", "s")]
    given += [(2, passage, "en", "s"), (2, "short", "en", "s"), (3, passage[9:] + " end", "en", "s")]
    assert suffix_dedup.remove_covered(documents(spark, given)).count() == 5
    assert phrase_automata.remove_passages(documents(spark, given)).count() == 5
