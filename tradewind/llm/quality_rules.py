"""Line-first cleaning with DataFrame functions only; no row leaves its partition.

Each line of a text is held against three kinds of rules: punctuation, navigation and
boilerplate. Lines that fail go, and a document that loses too much of its text, or fails the
base rules (too few words, too many repeated words), is rejected.

Every line has a verdict of its own. Lines that a hard wrap has broken inside a sentence are joined to a
paragraph only to acquit them: a line fails for want of a sentence mark only if its paragraph has none either,
and for phrases, which must make up an eighth of it, only if they also make up an eighth of its
paragraph. Lines in scripts that have no sentence marks need none. ``ORACLE`` states the same in SQL.

Defined results: a null text has no words and no lines, is rejected, and its cleaned text is
null; an empty text is rejected and stays empty. Repeated rows are judged one by one, and an empty
table gives an empty result. ``clean`` returns every input column unchanged (extra ones with any
name too) and one struct column; ``judge`` returns only the id and its own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import WORD_PATTERN, fresh, let, quoted, table, words_of

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
#: A document is rejected if more than this share of its characters stood in removed lines.
MAX_LOST_PERCENT = 50

SYMBOLS = "#*$%&|<>"
NAVIGATION_MARKS = "|›»•·"
#: Phrases of licences, notices and page furniture.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of (use|service)",
    "privacy policy",
    "cookie (policy|settings)",
    "accept (all )?cookies",
    "enable javascript",
    "lorem ipsum",
    "click here",
    "sign up for our",
    "subscribe to our",
)
BOILERPLATE_PATTERN = f"({'|'.join(BOILERPLATE)})"
SENTENCE_MARK = "[.!?:;…。！？]"
#: Marks of other scripts (Unicode's Sentence_Terminal, and those that stand for colons and semicolons).
OTHER_MARKS = (
    "‥‼⁇⁈⁉．｡：；।॥։՜՞؟؛۔؝؞܀܁܂߹။၊።፡፣፤፥፦፧፨។៕៖᙮᠃᠉᥄᥅᪨᪩᪪᪫᭚᭛᭞᭟᰻᰼᱾᱿꓿꘎꘏꛳꛷꡶꡷꣎꣏꤯꧈꧉꩝꩞꩟꫰꫱꯫།༎༏༐༑"
)
OTHER_MARK = f"[{OTHER_MARKS}]"
#: Letters of scripts that are written without sentence marks.
UNMARKED_LETTER = r"[\p{L}&&[\p{IsThai}\p{IsLao}\p{IsTai_Le}\p{IsNew_Tai_Lue}\p{IsTai_Viet}]]"
#: A paragraph fails if phrases make up a share of one in so many of its characters, or more.
BOILERPLATE_SHARE = 8
#: Lengths of lines that a hard wrap makes.
LEAST_WRAPPED, MOST_WRAPPED = 40, 120
ENDS = rf"[{SENTENCE_MARK[1:-1]}{OTHER_MARKS}][\"'”’»)\]]*[\x20\x09-\x0D]*\z"
#: Between paragraphs; no line that is part of a longer one is blank.
APART = "\n\f\n"


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _is_junk(line: Column, n_words: Column) -> Column:
    """Whether a line is navigation or symbols."""
    marks, symbols = _count(line, NAVIGATION_MARKS), _count(line, SYMBOLS)
    shouts = _count(line, "!")
    navigation = (marks >= 2) & (marks * 4 >= n_words)
    return (
        navigation
        | ((symbols >= 5) & (symbols * 2 >= n_words))
        | ((shouts >= 5) & (shouts * 2 >= n_words))
    )


def _is_unmarked(text: Column) -> Column:
    """Whether a text has no sentence mark; most have one of the first few."""
    return ~text.rlike(SENTENCE_MARK) & ~text.rlike(OTHER_MARK)


def _needs_marks(text: Column) -> Column:
    """Whether at least half of the letters are of scripts that have sentence marks."""
    without = F.regexp_count(text, F.lit(UNMARKED_LETTER))
    return without * 2 <= F.regexp_count(text, F.lit(r"\p{L}"))


def _is_boilerplate(text: Column) -> Column:
    lowered = F.lower(text)
    phrases = F.length(lowered) - F.length(F.regexp_replace(lowered, BOILERPLATE_PATTERN, ""))
    return lowered.rlike(BOILERPLATE_PATTERN) & (phrases * BOILERPLATE_SHARE >= F.length(text))


def _n_words(line: Column) -> Column:
    return F.regexp_count(line, F.lit(WORD_PATTERN))


def line_fails(line: Column) -> Column:
    """Whether a line that is a paragraph of its own breaks a rule; a blank line breaks none."""
    n_words = _n_words(line)
    return (
        _is_junk(line, n_words)
        | (~line.rlike(SENTENCE_MARK) & (n_words >= 5) & _is_unmarked(line) & _needs_marks(line))
        | _is_boilerplate(line)
    )


def paragraphs(lines: Column) -> Column:
    """The lines, those of a sentence that a hard wrap has broken in one string.

    A line is broken if it does not end a sentence and the next line's first word would not have fitted
    into the width of the lines around. Navigation, symbols and lines that mostly repeat their words are
    not taken for parts of a sentence.
    """

    def is_prose(line: Column) -> Column:
        n = _n_words(line)
        return ~_is_junk(line, n) & (F.size(F.array_distinct(words_of(line))) * 2 >= n)

    def length(line: Column) -> Column:
        return F.length(F.rtrim(line))

    def is_wrapped(line: Column, i: Column) -> Column:
        after, before = F.get(lines, i + 1), F.get(lines, i - 1)
        first = F.length(F.regexp_extract(after, WORD_PATTERN, 0))
        width = F.greatest(
            length(line), length(after), F.when(length(before) <= MOST_WRAPPED, length(before))
        )
        return F.coalesce(
            length(line).between(LEAST_WRAPPED, MOST_WRAPPED)
            & (length(after) <= MOST_WRAPPED)
            & (first > 0)
            & (length(line) + 1 + first > width)
            & ~line.rlike(ENDS)
            & is_prose(line)
            & is_prose(after),
            F.lit(False),
        )

    def ended(line: Column, i: Column) -> Column:
        end = F.when(i + 1 == F.size(lines), "").when(is_wrapped(line, i), "\n").otherwise(APART)
        return F.concat(line, end)

    return F.split(F.array_join(F.transform(lines, ended), ""), APART, -1)


def clean_lines(lines: Column) -> Column:
    """The lines that break no rule."""

    def passing(paragraph: Column) -> Column:
        verdict = F.struct(
            _is_unmarked(paragraph).alias("unmarked"), _is_boilerplate(paragraph).alias("boilerplate")
        )

        def left(v: Column) -> Column:
            return F.filter(
                F.split(paragraph, "\n", -1),
                lambda x: ~(
                    _is_junk(x, _n_words(x))
                    | (v["unmarked"] & (_n_words(x) >= 5) & _needs_marks(x))
                    | (v["boilerplate"] & _is_boilerplate(x))
                ),
            )

        return let(verdict, left)

    # Paragraphs only acquit lines, so where all pass by themselves none are needed.
    return F.when(
        F.exists(lines, line_fails), F.flatten(F.transform(paragraphs(lines), passing))
    ).otherwise(lines)


def repeated_words(words: Column) -> Column:
    """How many words stand in windows that occur twice or more among these words."""

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def again(found: Column) -> Column:
        """Starts of the windows that have an equal one, in order."""
        pairs = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def with_neighbour(sorted_pairs: Column) -> Column:
            at = lambda j: F.get(sorted_pairs, j)["h"]
            equal = F.filter(
                sorted_pairs,
                lambda x, j: x["h"].eqNullSafe(at(j + 1)) | x["h"].eqNullSafe(at(j - 1)),
            )
            return F.sort_array(F.transform(equal, lambda x: x["i"]))

        return let(F.sort_array(pairs), with_neighbour)

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(
                starts,
                lambda p, j: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))
                ),
            ),
            F.lit(0).cast("bigint"),
            lambda total, x: total + x,
        )

    # Few texts have any window twice; only those sort theirs.
    counted = let(
        let(F.transform(words, lambda w: F.xxhash64(w)), windows),
        lambda found: F.when(
            F.size(F.array_distinct(found)) < F.size(found), let(again(found), covered)
        ).otherwise(F.lit(0).cast("bigint")),
    )
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0).cast("bigint"))


def clean(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """The rows with a struct of the counts, the cleaned text and the verdict."""
    words, repeated, lines, cleaned, counts = map(
        fresh, ("words", "repeated", "lines", "cleaned", "counts")
    )
    value = quoted(text)
    step = docs.withColumn(words, words_of(value))
    step = step.withColumn(repeated, repeated_words(F.col(words)))
    step = step.withColumn(lines, F.split(value, "\n", -1))
    step = step.withColumn(cleaned, F.array_join(clean_lines(F.col(lines)), "\n"))
    repeated_lines = let(
        F.filter(lines, lambda x: x.rlike(WORD_PATTERN)),
        lambda full: F.size(full) - F.size(F.array_distinct(full)),
    )
    step = step.withColumn(
        counts,
        F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.coalesce(F.length(F.regexp_replace(value, r"[\x20\x09-\x0D]+", "")), F.lit(0))
            .cast("bigint").alias("word_chars"),
            F.coalesce(_count(value, SYMBOLS), F.lit(0)).cast("bigint").alias("n_symbols"),
            F.when(value.isNotNull(), repeated_lines).otherwise(0)
            .cast("bigint").alias("n_dup_lines"),
            F.col(repeated).alias("n_repeat_words"),
            F.coalesce(F.length(value) - F.length(cleaned), F.lit(0))
            .cast("bigint").alias("n_lost_chars"),
            F.coalesce(F.length(value), F.lit(0)).cast("bigint").alias("n_chars"),
        ),
    )
    c = F.col(counts)
    failed = (c["n_words"] < MIN_WORDS) | (
        c["n_repeat_words"] * 100 > c["n_words"] * MAX_REPEATED_PERCENT
    )
    lossy = c["n_lost_chars"] * 100 > c["n_chars"] * MAX_LOST_PERCENT
    return step.select(
        *[quoted(x) for x in docs.columns if x != into],
        F.struct(
            f"{counts}.*",
            failed.alias("base_failed"),
            (~failed & ~lossy).alias("kept"),
            F.col(cleaned).alias("text"),
        ).alias(into),
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    out = clean(docs.select(quoted(id_col), quoted(text)), text, "quality")
    return out.select(id_col, "quality.*")


def op10_quality_rules(spark, sf_dir):
    columns = (
        "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept "
        "n_lost_chars"
    )
    return judge(table(spark, sf_dir, "documents")).select(*columns.split())


def stage(spark, docs, sf_dir):
    """Rejected documents go; the others keep the lines that passed."""
    name, judged = fresh("quality"), fresh("judged")
    out = clean(docs, into=judged)
    # As a generator, so that the optimizer does not work out the rules once more for a filter.
    kept = F.filter(F.array(F.col(judged)), lambda x: x["kept"])
    out = out.select("*", F.explode(kept).alias(name)).drop(judged)
    replaced = {"text": F.col(name)["text"], "n_chars": F.length(F.col(name)["text"])}
    return out.select(
        *[
            replaced[c].cast(docs.schema[c].dataType).alias(c) if c in replaced else quoted(c)
            for c in docs.columns
        ]
    )


def _notice_sql(text: str) -> str:
    left = f"regexp_replace(lower({text}), '{BOILERPLATE_PATTERN}', '', 'g')"
    return (
        f"(regexp_matches(lower({text}), '{BOILERPLATE_PATTERN}')"
        f" AND (len(lower({text})) - len({left})) * {BOILERPLATE_SHARE} >= len({text}))"
    )


ENDS_SQL = ENDS.replace("'", "''")
UNMARKED_SCRIPTS_SQL = r"\p{Thai}\p{Lao}\p{Tai_Le}\p{New_Tai_Lue}\p{Tai_Viet}"
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(ws, i, i + {WINDOW - 1}) AS win
  FROM d, unnest(range(1, len(ws) - {WINDOW - 2})) AS t(i)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM again, range(0, {WINDOW}) AS r(j) GROUP BY doc_id
), lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)
), figures AS (
  SELECT *, regexp_extract_all(line, '{WORD_PATTERN}') AS words, len(words) AS n,
    len(rtrim(line, ' ')) AS long,
    len(line) - len(translate(line, '{NAVIGATION_MARKS}', '')) AS marks,
    len(line) - len(translate(line, '{SYMBOLS}', '')) AS symbols,
    len(line) - len(replace(line, '!', '')) AS shouts,
    (marks >= 2 AND marks * 4 >= n) OR (symbols >= 5 AND symbols * 2 >= n)
      OR (shouts >= 5 AND shouts * 2 >= n) AS junk,
    NOT junk AND len(list_distinct(words)) * 2 >= n AS prose
  FROM lines
), neighbours AS (
  SELECT *, lead(long) OVER w AS after, lag(long) OVER w AS before, lead(prose) OVER w AS prose_after,
    lead(len(words[1])) OVER w AS first
  FROM figures WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), wrapped AS (
  SELECT *, coalesce(
    long BETWEEN {LEAST_WRAPPED} AND {MOST_WRAPPED} AND after <= {MOST_WRAPPED} AND first > 0
    AND long + 1 + first > greatest(long, after, CASE WHEN before <= {MOST_WRAPPED} THEN before END)
    AND NOT regexp_matches(line, '{ENDS_SQL}') AND prose AND prose_after, false) AS goes_on
  FROM neighbours
), numbered AS (
  SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) - (NOT goes_on)::INT AS paragraph
  FROM wrapped
), paragraphs AS (
  SELECT doc_id, paragraph, string_agg(line, chr(10) ORDER BY i) AS whole FROM numbered GROUP BY doc_id, paragraph
), judged AS (
  SELECT doc_id, line, n, junk
    OR (n >= 5 AND NOT regexp_matches(whole, '{SENTENCE_MARK}') AND NOT regexp_matches(whole, '{OTHER_MARK}')
      AND 2 * len(regexp_replace(regexp_replace(line, '[^{UNMARKED_SCRIPTS_SQL}]', '', 'g'), '\P{{L}}', '', 'g'))
        <= len(regexp_replace(line, '\P{{L}}', '', 'g')))
    OR ({_notice_sql('line')} AND {_notice_sql('whole')}) AS fails
  FROM numbered JOIN paragraphs USING (doc_id, paragraph)
), by_line AS (
  SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
    coalesce(sum(len(line)) FILTER (NOT fails) + count(*) FILTER (NOT fails) - 1, 0) AS left_chars
  FROM judged GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(coalesce(len(text) - len(translate(text, '{SYMBOLS}', '')), 0) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(len(text) - left_chars, 0) AS BIGINT) AS n_lost_chars,
    coalesce(len(text), 0) AS n_chars
  FROM d LEFT JOIN by_line USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_chars,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
    AND n_lost_chars * 100 <= n_chars * {MAX_LOST_PERCENT} AS kept
FROM counts
"""
