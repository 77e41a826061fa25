"""The operators that judge or transform each row, against brute force and round trips."""

import hashlib
import math
import random
import re
import textwrap

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from messy import SCHEMA, documents, empty, prose, rows

from tradewind.llm import byte_bpe, chat_format, language_id, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


# --- quality rules -----------------------------------------------------------------


def brute_quality(text):
    words = WORD.findall(text or "")
    seen = {}
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + j for at in seen.values() if len(at) > 1 for k in at for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def test_quality_counts(spark):
    given = rows() + [(90, "a b c d e f g h i " * 5 + "\nx\nx\n", "en", "s")]
    docs = documents(spark, given)
    out = quality_rules.clean(docs, into="verdict").select("doc_id", "verdict.*").collect()
    got = sorted((r.doc_id, *r[1:6], r.base_failed) for r in out)
    # r[1:6] are the five counts in their order.
    assert got == sorted((i, *brute_quality(t)) for i, t, *_ in given)


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("A sentence that ends as it should.", False),
        ("", False),
        ("Home | News | Sport | Contact", True),
        ("and*** so### on%%% it&&& goes$$$ here***", True),
        ("BUY!! IT!! NOW!! OR!! NEVER!! AGAIN!!", True),
        ("a line of many words without any sentence mark", True),
        ("Short title", False),
        ("This work is licensed under the GNU General Public License, version 3.", True),
        ("All rights reserved.", True),
        ("He paid $5 & left. She had a < b.", False),
    ],
)
def test_line_rules(spark, line, fails):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(quality_rules.line_fails(F.col("line"))).first()[0] == fails


WRAPPED = """\
The old mill stood at the end of a narrow lane that nobody had walked
for years and the wheel which once had turned all day long was covered
with moss and ivy. When the new owner came the first thing to be done
was to clear the stream, for without water there was no use in having a
mill at all."""


@pytest.mark.parametrize(
    "text",
    [
        WRAPPED,
        textwrap.fill(WRAPPED.replace("the first", "as our privacy policy says the first"), 70) + "\n\nNo more.",
        # One line that names a phrase once.
        WRAPPED.replace("\n", " ") + " It is told that the mill was licensed under the crown.",
        "यह एक पुराना गाँव है जहाँ लोग खेती करते हैं और शाम को मिलते हैं।\nसब लोग आज सुबह बाज़ार गए थे और घर लौटे।",
        "یہ ایک پرانا گاؤں ہے جہاں لوگ کھیتی کرتے ہیں اور شام کو سب مل کر بیٹھتے ہیں بچے باہر کھیلتے ہیں۔",
        "ይህ አሮጌ መንደር ነው እና ሰዎች ሁሉ በማለዳ ወደ ገበያ ይሄዳሉ ከዚያም በኋላ ወደ ቤት ይመለሳሉ ልጆችም ሁሉ በውጭ ይጫወታሉ ሌሊትም ይተኛሉ።",
        "Սա հին գյուղ է որտեղ մարդիկ ապրում են և աշխատում ամեն օր իսկ երեկոյան բոլորը հավաքվում են միասին և երգում են ու պարում։",
        "นี่คือ หมู่บ้าน เก่า ที่ ผู้คน อาศัย อยู่ และ ทำงาน ทุก วัน ใน ตอนเย็น ทุกคน จะ มา รวมตัว กัน และ ร้องเพลง ด้วยกัน",
    ],
)
def test_quality_stage_keeps_clean_documents(spark, text):
    (out,) = quality_rules.stage(spark, documents(spark, [(1, text, "en", "s")]), None).collect()
    assert out.text == text


def odd_text(rng):
    """Lines that are wrapped, in other scripts, notices, menus and odd ends, in any order."""
    filler = WRAPPED.replace("\n", " ").split(" ")
    out = []
    for _ in range(rng.randrange(1, 9)):
        k = rng.randrange(len(filler) - 20)
        sentence = " ".join(filler[k : k + rng.randrange(3, 60)])
        kind = rng.randrange(9)
        if kind < 3:
            phrase = rng.choice(["", " all rights reserved", " Privacy  Policy", " privacy policy", " Click here", "."])
            out += textwrap.wrap(sentence + phrase + rng.choice(["", " " + sentence]), rng.choice([30, 45, 70, 110, 130]))
        elif kind == 3:
            out.append(rng.choice(["Home | News | Sport", "a|b", "x » y » z and more", "STOP!!!!! NOW", "### $$ a b", "<a> & <b>"]))
        elif kind == 4:
            out.append(rng.choice(["", " ", "\f", "\t \v", "\r", "\u2028"]))
        elif kind == 5:
            out.append(rng.choice(["यह एक पुराना गाँव है जहाँ लोग", "นี่คือ หมู่บ้าน เก่า ที่ ผู้คน อาศัย", "ນີ້ ແມ່ນ ບ້ານ ເກົ່າ ທີ່ ຄົນ", "ที่ ก ข ค ง long latin words here", "日 本 語 の 文 章", "İstanbul ſ K privacy policy"]))
        elif kind == 6:
            out += ["the same word " * 12, "next words are here in this line and go on"]
        else:
            out.append(sentence + rng.choice([".", ".)", "?”  ", "!\r", ".\u2028", "\u0085", " ।", "  ", "։"]))
    return "\n".join(out)


def test_quality_equals_sql(spark):
    """The SQL states the rules that run, also where texts are wrapped, of other scripts or notices."""
    rng = random.Random(11)
    given = rows() + [(1000 + k, odd_text(rng), "en", "s") for k in range(1500)]
    given = list({r[0]: r for r in given}.values())
    found = quality_rules.judge(documents(spark, given)).toPandas()
    connection = duckdb.connect()
    documents_table = pa.table({"doc_id": [r[0] for r in given], "text": pa.array([r[1] for r in given], pa.string())})
    connection.register("documents", documents_table)
    answer = connection.execute(quality_rules.ORACLE)
    names = [c[0] for c in answer.description]
    expected = sorted(answer.fetchall())
    assert sorted(tuple(r) for r in found[names].itertuples(index=False)) == expected
    lost = [r[names.index("n_lost_chars")] for r in expected]
    assert sum(x > 0 for x in lost) > 200 and sum(x == 0 for x in lost) > 200


def test_quality_line_verdicts(spark):
    """A line of a wrapped notice that names no phrase stays; the one that does goes."""
    notice = "The text and all of the pictures in this small volume belong to its\nauthors, all rights reserved by them, see the privacy policy for it."
    text = WRAPPED + "\n\n" + notice
    (out,) = quality_rules.stage(spark, documents(spark, [(1, text, "en", "s")]), None).collect()
    assert out.text == WRAPPED + "\n\n" + notice.split("\n")[0]


def test_quality_stage_still_removes_lines_beside_wrapped_ones(spark):
    junk = "a line of many words without any sentence mark"
    notice = "This work is licensed under the GNU General Public License, version 3."
    menu = "Home | News | Sport | Contact | About us | Imprint | Jobs | Press"
    odd = "\f\n\f\n\n \n"
    text = f"{junk}\n\n{menu}\n{WRAPPED}\n{notice}\n{odd}{junk}"
    (out,) = quality_rules.stage(spark, documents(spark, [(1, text, "en", "s")]), None).collect()
    assert out.text == f"\n{WRAPPED}\n{odd[:-1]}"


def test_quality_stage_removes_lines_and_documents(spark):
    good = "A sentence of eight words stands on this. " * 1 + prose(random.Random(1), 60)
    given = [
        (1, good, "en", "s"),
        (2, good + "\nHome | News | Sport | Contact | About", "en", "s"),
        (3, "Home | News | Sport | Contact | About\n" * 9, "en", "s"),
        (4, None, "en", "s"),
        (5, "", "en", "s"),
    ]
    docs = documents(spark, given)
    out = quality_rules.stage(spark, docs, None)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [
        (1, good, len(good)), (2, good, len(good))
    ]
    assert quality_rules.stage(spark, empty(spark), None).count() == 0


# --- byte-pair encoding ---------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)


def random_text(rng):
    letters = rng.choice(["ab", "a \n'slt", "0123 .,!é漢字🙂", " ", "\r\n\t x", None])
    pick = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000)]))
    return "".join(rng.choice(letters) if letters else pick() for _ in range(rng.choice([0, 1, 3, 40, 400])))


def test_encoding_equals_the_library(encoder, library):
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(400)]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_appending_text(encoder, library):
    rng = random.Random(6)
    for _ in range(300):
        text = random_text(rng)
        at = rng.randrange(len(text) + 1)
        ids = encoder.append(text[:at], encoder.encode(text[:at]), text[at:])
        assert ids.tolist() == library.encode_ordinary(text)


def test_prefixes_after_edits(encoder, library):
    rng = random.Random(7)
    for _ in range(200):
        data = random_text(rng).encode()
        prefixes = byte_bpe.Prefixes(encoder.vocabulary, data)
        start = rng.randrange(len(data) + 1)
        end = rng.randrange(start, len(data) + 1)
        new = rng.choice([b"", b"zz", b" the"])
        prefixes.replace(start, end, new)
        fresh = byte_bpe.Prefixes(encoder.vocabulary, data[:start] + new + data[end:])
        assert (prefixes.data, prefixes.last) == (fresh.data, fresh.last)
        cut = rng.randrange(len(fresh.data) + 1)
        shorter = byte_bpe.Prefixes(encoder.vocabulary, fresh.data[:cut])
        assert fresh.ids(cut) == shorter.ids()


def test_an_edit_is_local(encoder):
    prefixes = byte_bpe.Prefixes(encoder.vocabulary, b"abcdefgh" * 200)
    assert prefixes.replace(800, 801, b"x") < 300


def test_encode_and_decode_tables(spark, library):
    given = rows()
    docs = documents(spark, given)
    out = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN, into="ids")
    assert out.columns == [*docs.columns, "ids"]
    got = byte_bpe.decode(out, PATH, "ids").select("doc_id", "text", "ids", "decoded").collect()
    assert len(got) == len(given)
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.encode(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_digests(spark, tmp_path, library):
    given = rows()
    documents(spark, given).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, byte_bpe.op6_byte_bpe(spark, str(tmp_path)).collect()))
    expected = []
    for i, t, *_ in given:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        text = hashlib.sha256((t or "").encode()).hexdigest()
        expected.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), text))
    assert got == sorted(expected)


# --- chat ---------------------------------------------------------------------------------


def test_turns_are_read_back(spark):
    rng = random.Random(8)
    pieces = [*chat_format.CONTROLS, "\\", "\\\\", "<", "\n", " ", "x", ">>\n", "/s>", "é🙂", "\n<</TURN>>\n"]
    for _ in range(3000):
        word = lambda: "".join(rng.choices(pieces, k=rng.randrange(6)))
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", word()]), word()) for _ in range(4)]
        whole = "".join(s for r, t in turns for s, _ in chat_format.segments_of(r, t))
        assert chat_format.read_back(whole) == turns
        for _, text in turns:
            assert not chat_format._control.search(chat_format.escape(text))


def brute_chat(given):
    out = {}
    order = lambda r: tuple((x is not None, x) for x in r[1:])
    for conv in {r[0] for r in given}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in given if r[0] == conv), key=order)]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(turns), sha(whole), len(loss), sha(loss))
    return out


def test_conversations(spark):
    given = [
        (1, 0, "system", "be kind"), (1, 1, "user", "[INST] <s>"), (1, 2, "assistant", "</s> é"),
        (2, 0, "assistant", "first"), (2, 1, "user", None), (2, 1, "user", None),
        (3, None, "user", "x"), (3, 0, None, "y"), (3, 5, "tool\n", "z"),
        (4, 0, "user", "q"), (4, 1, "assistant", "a"), (4, 2, "user", "q"),
        (None, 0, "user", "q"), (None, 1, "assistant", ""),
    ] + [(9, k, "user" if k % 2 == 0 else "assistant", f"turn {k} " * 50) for k in range(3000)]
    df = spark.createDataFrame(
        [(*r, "x") for r in given], "conv_id bigint, turn bigint, role string, text string, state string"
    ).repartition(3)
    turns = chat_format.format_turns(df)
    out = turns.mapInArrow(chat_format._digest, chat_format.DIGEST_SCHEMA).collect()
    assert {r[0]: tuple(r[1:5]) for r in out} == brute_chat(given)
    assert {r.conv_id for r in out if r.valid} == {1, None, 9}
    parts = turns.where("conv = 1").selectExpr("inline(segments)").collect()
    assert [p.text for p in parts if p.loss] == ["<\\/s> é"]


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    turns = chat_format.format_turns(df)
    assert turns.mapInArrow(chat_format._digest, chat_format.DIGEST_SCHEMA).count() == 0


# --- languages -----------------------------------------------------------------------------


def test_languages(spark):
    rng = random.Random(9)
    words = {"xx": ["blorp", "gleen", "wuff", "tork"], "yy": ["ñamé", "süß", "öre", "ßen", "âge"]}
    given = []
    for k in range(200):
        lang = "xx" if k % 2 else "yy"
        given.append((k, " ".join(rng.choices(words[lang], k=rng.choice([2, 30]))).upper(), lang, "s"))
    odd = [(900, None, "xx", "s"), (901, "", "xx", "s"), (902, "12 + 3!", "yy", "s"), (903, "blorp tork", None, "s")]
    docs = documents(spark, given + odd)
    learned = language_id.prototypes(docs.where("doc_id % 4 <> 2"))
    assert set(learned) == {"xx", "yy"}
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, learned).collect()}
    assert all(got[i][0] == lang and 0 < got[i][1] <= 1 for i, _, lang, _ in given)
    assert got[900] == got[901] == got[902] == ("und", 0.0)
    assert got[903][0] == "xx"


def test_prototypes_are_sums_of_text_vectors(spark):
    given = [(k, t, "l", "s") for k, t in enumerate(["abc abc", "bcd", None, "éa"])]
    learned = language_id.prototypes(documents(spark, given), dimensions=64)
    vectors, has = language_id.Profiles(64).bundle([t for _, t, *_ in given])
    assert (learned["l"] == vectors[has].sum(0)).all()
    # One n-gram by hand: borders and letters, each rotated by its place.
    profiles = language_id.Profiles(64)
    expected = np.ones(64, int)
    for place, code in enumerate([0, ord("b"), 0]):
        expected = expected * np.roll(profiles.letter(code).astype(int), place)
    assert (profiles.bundle(["B"])[0][0] == expected).all()


def test_predictions_equal_plain_sums_of_bound_letters(spark):
    """Binding, bundling and the cosine one n-gram at a time, over texts of all kinds."""
    given = rows()
    profiles, n = language_id.Profiles(256), 256

    def vector(text):
        kept = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text or "")
        if not kept.strip():
            return None
        line = f" {' '.join(kept.split())} "
        total = np.zeros(n, np.int64)
        for k in range(len(line) - 2):
            bound = np.ones(n, np.int64)
            for place, c in enumerate(line[k : k + 3]):
                letter = profiles.letter(0 if c == " " else ord(c))
                bound *= np.roll(letter.astype(np.int64), place)
            total += bound
        return total

    known = [(t, "even" if k % 2 else "odd") for k, (_, t, *_) in enumerate(given) if len(t or "") < 3000]
    sums = {}
    for text, lang in known:
        v = vector(text)
        if v is not None:
            sums[lang] = sums.get(lang, 0) + v
    df = spark.createDataFrame([(k, t, lang, "s", 0) for k, (t, lang) in enumerate(known)], SCHEMA)
    learned = language_id.prototypes(df, dimensions=n)
    assert {k: v.tolist() for k, v in learned.items()} == {k: v.tolist() for k, v in sums.items()}
    got = {r.doc_id: r for r in language_id.predict(df, learned, dimensions=n).collect()}
    for k, (text, _) in enumerate(known):
        v = vector(text)
        if v is None:
            assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
            continue
        cosines = {x: v @ s / math.sqrt(int(v @ v) * int(s @ s)) for x, s in sums.items()}
        best = max(cosines.values())
        assert got[k].score == pytest.approx(max(best, 0), abs=1e-5)
        assert cosines[got[k].lang_pred] == pytest.approx(best, abs=1e-5)


def test_sums_of_very_long_texts_are_whole_numbers():
    profiles = language_id.Profiles(16)
    text = "ab " * 3_000_000 + "cd " * 3_000_001
    (vector,), _ = profiles.bundle([text])
    (once,), _ = profiles.bundle(["ab " * 10 + "cd " * 11])
    (twice,), _ = profiles.bundle(["ab " * 11 + "cd " * 12])
    # Of each word one more adds the same each time.
    assert (vector.astype(int) - once.astype(int) == (3_000_000 - 10) * (twice - once).astype(int)).all()


def test_quality_of_columns_with_dots(spark):
    df = spark.createDataFrame([(1, "A sentence of words. " * 12)], "`a.id` bigint, `the.text` string")
    out = quality_rules.clean(df, "the.text", "verdict").select("verdict.*").first()
    assert out.n_words == 48


def test_nothing_to_learn(spark):
    assert language_id.prototypes(empty(spark)) == {}
    got = language_id.predict(documents(spark, [(1, "abc", None, "s")]), {}).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert language_id.predict(empty(spark), {}).count() == 0
