"""BPE with word ends against the tokenizers library."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from messy import documents, empty, rows
from tokenizers import Tokenizer

from tradewind.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return word_bpe.Encoder(file.read())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def random_text(rng):
    pools = [
        "ab", "a 'slt", "0123 .,!é漢字🙂", " \r\n\t\x0b\x85  x", "Σσςİ AΣ", "éa̧ë́",
        ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "a", " "], None,
    ]
    letters = rng.choice(pools)
    ranges = [(32, 127), (160, 0x3000), (0x10000, 0x1F000), (0xA000, 0xD7FF), (0x2FC00, 0x30000)]
    pick = lambda: chr(rng.randrange(*rng.choice(ranges)))
    return "".join(rng.choice(letters) if letters else pick() for _ in range(rng.choice([0, 1, 3, 40, 400])))


def test_encoding_equals_the_library(encoder, library):
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(800)] + ["x" * 3000, "ab" * 2000 + "<|endoftext|>"]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert ids.tolist() == ids_of(library, text), text
        assert encoder.decode(ids.tolist()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_every_character_is_cut_like_the_library_does(encoder, library):
    # One character of each kind is enough in a stretch of the same kind; all of the first plane.
    points = [*range(0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x110000, 97)]
    texts = [f"A{chr(c)}{chr(c)}s1{chr(c)}" for c in points]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert ids.tolist() == ids_of(library, text), text


def test_shared_prefixes_are_nodes_once(encoder):
    words = sorted(map(word_bpe.symbols_of, ["abc", "abcd", "abd", "b", "abcd" * 2]))
    trie = word_bpe.Trie(encoder.vocabulary, words)
    prefixes = {w[:n] for w in words for n in range(1, len(w) + 1)}
    assert len(trie.last) == len(prefixes) + 1
    for word, leaf in zip(words, trie.leaves, strict=True):
        alone = word_bpe.Trie(encoder.vocabulary, [word])
        assert trie.ids(leaf) == alone.ids(alone.leaves[0])


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHED_WORDS", 20)
    monkeypatch.setattr(word_bpe, "CACHED_PAIRS", 50)
    with open(PATH, encoding="utf-8") as file:
        encoder = word_bpe.Encoder(file.read())
    rng = random.Random(8)
    for _ in range(60):
        texts = [random_text(rng) for _ in range(5)] + ["y" * 300, "the mill stood <|endoftext|>"]
        for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
            assert ids.tolist() == ids_of(library, text)
    assert len(encoder.known) < 2000


def test_tables(spark, library):
    given = rows() + [(95, "A<|endoftext|>b  <|STARTOFTEXT|>", "en", "s")]
    docs = documents(spark, given)
    out = word_bpe.encode(docs, PATH, into="ids")
    assert out.columns == [*docs.columns, "ids"]
    got = word_bpe.decode(out, PATH, "ids").select("doc_id", "text", "ids", "decoded").collect()
    assert len(got) == len(given)
    for r in got:
        assert r.ids == ids_of(library, r.text or "")
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert word_bpe.encode(empty(spark), PATH).count() == 0
    nothing = spark.createDataFrame([(None,)], "tokens array<int>")
    assert word_bpe.decode(nothing, PATH).first().decoded is None


def test_digests(spark, tmp_path, library):
    given = rows()
    documents(spark, given).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, word_bpe.op11_word_bpe(spark, str(tmp_path)).collect()))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for i, t, *_ in given:
        ids = ids_of(library, t or "")
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert got == sorted(expected)


@pytest.mark.parametrize("change", [{"normalizer": None}, {"decoder": {"type": "BPEDecoder"}}])
def test_other_files_are_refused(change):
    with open(PATH, encoding="utf-8") as file:
        given = json.load(file)
    with pytest.raises(ValueError, match="not a tokenizer file"):
        word_bpe.Encoder(json.dumps(given | change))
