"""URL filter: rules on host and path, and a character language-model ratio for the rest.

Two variable-order Markov models over host and path are counted from the URLs that the rules accept
and reject: an n-gram's probability mixes the counts of its longest context with those of ever shorter
ones (Witten-Bell), down to the uniform distribution. A URL without a rule is judged by the
difference of its log-likelihoods, divided by its length, against the threshold that parts accepted
from rejected URLs best. Counts and threshold come from all rows, and all of it is joins and
aggregates of n-gram tables; only the threshold reaches the driver.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule, and is
judged by the models as an empty sequence. If the rules accept or reject no URL at all, the others
are allowed, like the URLs at the threshold itself. Repeated rows are judged alike and count as often as
they occur. An empty table gives no rows. Only id and url are read, so that other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import Scratch, quoted, table

#: (verdict, host and path)
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Characters of an n-gram: the longest context is one shorter.
ORDER = 5
ALPHABET = 256
#: Steps of the threshold.
STEPS = 1000
BEFORE, AFTER = "\x02", "\x03"
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def by_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda x: len(x[1])):
        rule_host, rule_path = _split_rule(rule)
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, rule).otherwise(found)
        verdict = F.when(fits, kind).otherwise(verdict)
    return found, verdict


def parse(pages: DataFrame, id_col: str, url: str, rules=RULES) -> DataFrame:
    part = lambda k: F.coalesce(F.regexp_extract(quoted(url), URL_PATTERN, k), F.lit(""))
    out = pages.select(
        quoted(id_col), F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path")
    )
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    return out.withColumns({"rule": rule, "ruled": verdict})


def grams_of(host: Column, path: Column) -> Column:
    """An n-gram for each character and one for the end, cut in one pass."""
    whole = F.concat(F.lit(BEFORE * (ORDER - 1)), host, path, F.lit(AFTER))
    # Not from the second half of a character that has two.
    return F.regexp_extract_all(whole, F.lit(rf"(?s)(?!\p{{Cs}})(?=(.{{{ORDER}}}))"), F.lit(1))


def model(grams: DataFrame) -> DataFrame:
    """(gram, ratio): log-probability of the last character, accepted minus rejected.

    ``grams`` has gram, good and bad, its counts in accepted and rejected URLs, each gram once.
    """
    level = None
    for size in range(1, ORDER + 1):
        ends = grams.groupBy(F.expr(f"right(gram, {size})").alias("gram")).agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad")
        )
        ends = ends.withColumn("context", F.expr(f"left(gram, {size - 1})"))
        contexts = ends.groupBy("context").agg(
            *[F.sum(c).alias(f"{c}_all") for c in ("good", "bad")],
            *[F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_kinds") for c in ("good", "bad")],
        )
        step = ends.join(contexts, "context")
        if level is None:
            step = step.withColumns({f"{c}_less": F.lit(1 / ALPHABET) for c in ("good", "bad")})
        else:
            shorter = level.select(
                F.col("gram").alias("shorter"),
                *[F.col(f"{c}_p").alias(f"{c}_less") for c in ("good", "bad")],
            )
            step = step.withColumn("shorter", F.expr(f"right(gram, {size - 1})"))
            step = step.join(shorter, "shorter")
        level = step.select(
            "gram",
            *[
                F.when(
                    F.col(f"{c}_kinds") > 0,
                    (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_less"))
                    / (F.col(f"{c}_all") + F.col(f"{c}_kinds")),
                )
                .otherwise(F.col(f"{c}_less"))
                .alias(f"{c}_p")
                for c in ("good", "bad")
            ],
        )
    return level.select("gram", (F.ln("good_p") - F.ln("bad_p")).alias("ratio"))


def threshold_of(scores: DataFrame) -> float | None:
    """The score from which on URLs are allowed; null without URLs of both kinds.

    Scores are counted in steps, so that few rows are left however many URLs there are.
    """
    steps = scores.groupBy(F.floor(F.col("score") * STEPS).alias("step")).agg(
        F.sum(F.expr("if(ruled = 'allow', n, 0)")).alias("good"),
        F.sum(F.expr("if(ruled = 'block', n, 0)")).alias("bad"),
    )
    # A log ratio lies within some tens, so there are some ten thousand steps at most.
    rows = sorted((r["step"], r["good"], r["bad"]) for r in steps.collect())
    n_good, n_bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not n_good or not n_bad:
        return None
    best, chosen, lower_good, lower_bad = -1, 0, 0, 0
    for step, good, bad in rows:
        # Allowing from this step on: bad ones below it and good ones from it are right.
        right = lower_bad * n_good + (n_good - lower_good) * n_bad
        if right > best:
            best, chosen = right, step
        lower_good, lower_bad = lower_good + good, lower_bad + bad
    return chosen / STEPS


def judge(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", rules=RULES
) -> DataFrame:
    """id, host, path, rule, verdict and score of every row; the score is null under a rule."""
    scratch = Scratch(pages.sparkSession)
    parsed = parse(pages, id_col, url, rules)
    # Equal sequences are scored once; a hot URL is a single row from here on. Its n-grams carry its
    # number alone, however long it is.
    sequences = parsed.groupBy("host", "path").agg(
        F.first("ruled", ignorenulls=True).alias("ruled"), F.count("*").alias("n")
    )
    sequences = scratch.put("sequences", sequences.withColumn("seq", F.monotonically_increasing_id()))
    exploded = sequences.select(
        "seq", "ruled", "n", F.explode(grams_of(F.col("host"), F.col("path"))).alias("gram")
    )
    counts = exploded.groupBy("gram").agg(
        F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)).alias("bad"),
    )
    ratios = model(scratch.put("grams", counts))
    # The sum runs in whole steps of 1e-9, so that its order does not matter. The n-grams are many
    # times larger than the planner takes them for, so neither side may be broadcast.
    scores = (
        exploded.select("seq", "gram").hint("merge").join(ratios, "gram")
        .groupBy("seq")
        .agg((F.sum(F.round(F.col("ratio") * 1e9).cast("bigint")) / F.count("*") / 1e9).alias("score"))
    )
    scored = scratch.put("scored", sequences.hint("merge").join(scores, "seq").drop("seq"))
    each = scored.where("ruled is not null").select("ruled", "score", "n")
    threshold = threshold_of(each)
    found = scored.drop("ruled", "n").hint("merge")
    free = parsed.where("rule is null").join(found, ["host", "path"])
    passes = F.lit(True) if threshold is None else F.col("score") >= threshold
    rest = free.withColumn("verdict", F.when(passes, "allow").otherwise("block"))
    ruled = parsed.where("rule is not null").select(
        "*", F.lit(None).cast("double").alias("score"), F.col("ruled").alias("verdict")
    )
    names = [id_col, "host", "path", "rule", "verdict", "score"]
    return ruled.select(*map(quoted, names)).unionAll(rest.select(*map(quoted, names)))


def op2_url_filter(spark, sf_dir):
    out = judge(table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def _sql_model() -> str:
    parts = []
    for size in range(1, ORDER + 1):
        parts.append(f"""ends_{size} AS (
  SELECT right(gram, {size}) AS gram, left(right(gram, {size}), {size - 1}) AS context,
    sum(good) AS good, sum(bad) AS bad FROM grams GROUP BY ALL
), contexts_{size} AS (
  SELECT context, sum(good) AS good_all, sum(bad) AS bad_all, count(*) FILTER (good > 0) AS good_kinds,
    count(*) FILTER (bad > 0) AS bad_kinds FROM ends_{size} GROUP BY context
)""")
        less = "1.0::DOUBLE / 256" if size == 1 else "s.{c}_p"
        columns = ", ".join(
            f"CASE WHEN {c}_kinds > 0 THEN ({c} + {c}_kinds * ({less.format(c=c)}))"
            f" / ({c}_all + {c}_kinds) ELSE {less.format(c=c)} END AS {c}_p"
            for c in ("good", "bad")
        )
        shorter = f" JOIN level_{size - 1} s ON s.gram = right(e.gram, {size - 1})" * (size > 1)
        parts.append(f"""level_{size} AS MATERIALIZED (
  SELECT e.gram, {columns} FROM ends_{size} e JOIN contexts_{size} USING (context){shorter}
)""")
    return ", ".join(parts)


def _sql_rules(what: int) -> str:
    cases = []
    for rule in sorted(RULES, key=lambda x: -len(x[1])):
        host, path = _split_rule(rule[1])
        cases.append(
            f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
            f" THEN '{rule[what]}'"
        )
    return f"CASE {' '.join(cases)} END"


ORACLE = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{URL_PATTERN}', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '{URL_PATTERN}', 2) AS path FROM pages
), parsed AS (
  SELECT *, {_sql_rules(1)} AS rule, {_sql_rules(0)} AS ruled FROM parts
), wholes AS (
  SELECT *, repeat(chr(2), {ORDER - 1}) || host || path || chr(3) AS whole FROM parsed
), exploded AS (
  SELECT page_id, ruled, substr(whole, i, {ORDER}) AS gram
  FROM wholes, unnest(range(1, len(whole) - {ORDER - 2})) AS t(i)
), grams AS (
  SELECT gram, count(*) FILTER (ruled = 'allow') AS good, count(*) FILTER (ruled = 'block') AS bad
  FROM exploded GROUP BY gram
), {_sql_model()}, scores AS (
  SELECT page_id, ruled, sum(CAST(round((ln(good_p) - ln(bad_p)) * 1e9) AS BIGINT)) / count(*) / 1e9 AS score
  FROM exploded JOIN level_{ORDER} USING (gram) GROUP BY ALL
), steps AS (
  SELECT floor(score * {STEPS}) AS step, count(*) FILTER (ruled = 'allow') AS good,
    count(*) FILTER (ruled = 'block') AS bad FROM scores WHERE ruled IS NOT NULL GROUP BY ALL
), sums AS (
  SELECT step, coalesce(sum(bad) OVER below, 0) * sum(good) OVER ()
    + (sum(good) OVER () - coalesce(sum(good) OVER below, 0)) * sum(bad) OVER () AS rightly,
    sum(good) OVER () AS n_good, sum(bad) OVER () AS n_bad
  FROM steps WINDOW below AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT step / {STEPS} AS threshold FROM sums WHERE n_good > 0 AND n_bad > 0
  ORDER BY rightly DESC, step LIMIT 1
)
SELECT page_id, host, path, rule, coalesce(parsed.ruled,
  CASE WHEN score < (SELECT threshold FROM chosen) THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed JOIN scores USING (page_id)
"""
