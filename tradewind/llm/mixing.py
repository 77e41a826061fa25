"""Mixing sources to target weights with DataFrame functions only.

The sources form a tree: domain, language, source. A token budget runs down from the root, to each
child by its weight. A child that cannot take its share, even when repeated for the allowed number of
epochs, takes what it can, and its siblings share the rest by weight; only what a whole family cannot
take goes to the families beside it. A leaf's quota is then filled epoch by epoch: whole epochs first,
then a prefix of one more in a seeded order of its own, as long as the quota lasts.

Where the prefix ends is found from sums per slice of the order, then inside the one slice in which it
ends, so no task orders a whole leaf. What comes out of that is one row per leaf, and each document
is kept or repeated by its leaf's row alone.

Defined results: null languages and sources are leaves of their own; a document without words (null
or empty text) is never taken; rows with equal ids and sources stand and fall together; a weight of
zero takes nothing. An empty table gives no rows. Input columns are passed on unchanged whatever their
names are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import WORD_PATTERN, Scratch, fresh, quoted, table

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of the seeded order that name a slice of it.
SLICE_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """Weights by level and name (others weigh 1), and how much to take.

    ``domains`` maps sources to domains; others belong to ``other_domain``.
    """

    domains: dict[str, str] = field(default_factory=dict)
    other_domain: str = "other"
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    budget_percent: int = 60
    max_epochs: int = 2
    seed: int = 7


#: The largest source is a crawl, the next nine are books, the others are forums.
PRODUCTION = Mix(
    domains={"src0": "crawl", **{f"src{k}": "books" for k in range(1, 10)}},
    other_domain="forums",
    weights={
        "domain": {"crawl": 3, "books": 5, "forums": 2},
        "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
        "source": {"src1": 2, "src10": 4},
    },
)


def _case(value: Column, cases: dict, other) -> Column:
    out = F.lit(other)
    for key, result in cases.items():
        out = F.when(value == key, F.lit(result)).otherwise(out)
    return out


def _long(value) -> Column:
    return value.cast("decimal(38,0)")


def _share(nodes: DataFrame, parents: list[str], budget: Column) -> DataFrame:
    """``given``: what each node gets of its parents' budget, by weight, up to its ``most``."""
    siblings = Window.partitionBy(*parents)
    by_need = siblings.orderBy(F.col("most") / F.col("weight"), *LEVELS[: len(parents) + 1])
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    on = by_need.rowsBetween(0, Window.unboundedFollowing)
    left = _long(budget) - F.coalesce(F.sum("most").over(before), F.lit(0))
    full = _long(F.col("most")) * F.sum("weight").over(on) <= _long(F.col("weight")) * left
    step = nodes.withColumn("full", full)
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(siblings), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings)
    given = F.expr("weight * (budget - spent) div open_weight")
    return (
        step.withColumns(
            {"budget": _long(budget), "spent": spent, "open_weight": open_weight}
        )
        .withColumn("given", F.when(F.col("full"), F.col("most")).otherwise(given))
        .withColumn("given", F.greatest(F.col("given").cast("bigint"), F.lit(0)))
        .drop("full", "spent", "open_weight", "budget")
    )


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with ``quota``, the tokens to take of each."""
    for level in LEVELS:
        weights = mix.weights.get(level, {})
        leaves = leaves.withColumn(f"{level}_weight", _case(F.col(level), weights, 1))
    usable = F.least(*[F.col(f"{level}_weight") for level in LEVELS]) > 0
    most = F.when(usable, F.col("tokens") * mix.max_epochs).otherwise(0)
    tree = leaves.withColumn("most", most).where("most > 0")
    given = leaves.withColumn("most", most).groupBy("domain").agg(
        F.sum("most").alias("most"),
        F.sum("tokens").alias("tokens"),
        F.first("domain_weight").alias("weight"),
    )
    # The total over the domains, of which there are few.
    given = given.withColumn("all", F.sum("tokens").over(Window.partitionBy()))
    given = given.withColumn("root", F.expr(f"`all` * {mix.budget_percent} div 100"))
    given = _share(given.where("most > 0"), [], F.col("root")).select("domain", "given")
    for depth in (2, 3):
        keys, parents = LEVELS[:depth], LEVELS[: depth - 1]
        nodes = tree.groupBy(*keys).agg(
            F.sum("most").alias("most"), F.first(f"{keys[-1]}_weight").alias("weight")
        )
        above = given.select(
            *[F.col(p).alias(f"of_{p}") for p in parents], F.col("given").alias("above")
        )
        same = [F.col(p).eqNullSafe(F.col(f"of_{p}")) for p in parents]
        given = _share(nodes.join(above, same), list(parents), F.col("above")).select(
            *keys, "given"
        )
    return given.withColumnRenamed("given", "quota")


def order_key(doc_id: Column, epoch: Column, seed: int) -> Column:
    return F.md5(
        F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")).cast("binary")
    )


def plan(units: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf: its keys, ``whole`` epochs, and ``last``, where the next epoch's prefix ends.

    ``units`` has a row (id, domain, lang, source, tokens) for each document.
    """
    leaves = units.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    named = [F.col(x).alias(f"of_{x}") for x in LEVELS]
    same = [F.col(x).eqNullSafe(F.col(f"of_{x}")) for x in LEVELS]
    quotas = budgets(leaves, mix).select(*named, "quota")
    goals = leaves.join(quotas, same).select(
        *LEVELS,
        F.expr("quota div tokens").alias("whole"),
        F.expr("quota % tokens").alias("rest"),
    )
    goal = goals.select(*named, "whole", "rest")
    keyed = units.join(goal, same).select(
        *LEVELS, "whole", "rest", "tokens",
        order_key(F.col("id"), F.col("whole") + 1, mix.seed).alias("key"),
    )
    keyed = keyed.withColumn("slice", F.left("key", F.lit(SLICE_DIGITS)))
    slices = keyed.groupBy(*LEVELS, "slice").agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest")
    )
    up_to = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        slices.withColumn("through", F.sum("tokens").over(up_to))
        .withColumn("before", F.col("through") - F.col("tokens"))
        .where("before <= rest and rest < through")
    )
    ending = ends.select(*named, F.col("slice").alias("end_slice"), "before")
    # Only the slice in which the prefix ends is put in order.
    inside = keyed.join(ending, [*same, F.col("slice") == F.col("end_slice")])
    inside = inside.groupBy(*LEVELS, "key").agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"),
        F.first("before").alias("before"),
    )
    by_key = Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    taken = inside.withColumn("through", F.col("before") + F.sum("tokens").over(by_key))
    last = taken.where("through <= rest").groupBy(*LEVELS).agg(F.max("key").alias("last_key"))
    last = last.select(*named, "last_key")
    done = goals.join(ending.drop("before"), same, "left").drop(*[f"of_{x}" for x in LEVELS])
    done = done.join(last, same, "left").drop(*[f"of_{x}" for x in LEVELS])
    # Without a key of its own in the last slice, the prefix ends with the slice before it.
    return done.select(*LEVELS, "whole", F.coalesce("last_key", "end_slice").alias("last"))


def mix_sources(
    docs: DataFrame, mix: Mix, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
    source: str = "source", into: str = "mix",
) -> DataFrame:
    """The input's rows, once for each epoch that takes them, and a struct column ``into``."""
    scratch = Scratch(docs.sparkSession)
    domain = _case(quoted(source), mix.domains, mix.other_domain)
    units = docs.select(
        quoted(id_col).alias("id"),
        domain.alias("domain"),
        quoted(lang).cast("string").alias("lang"),
        quoted(source).cast("string").alias("source"),
        F.regexp_count(quoted(text), F.lit(WORD_PATTERN)).cast("bigint").alias("tokens"),
    )
    # Texts are read once for their sizes; all planning reads this narrow table.
    units = scratch.put("units", units.where("tokens > 0"))
    rows = scratch.put("plan", plan(units, mix))
    at = {c: fresh(c) for c in (*LEVELS, "whole", "last", "epoch", "tokens")}
    rows = rows.select(*[F.col(c).alias(at[c]) for c in rows.columns])
    same = [
        domain.eqNullSafe(F.col(at["domain"])),
        quoted(lang).cast("string").eqNullSafe(F.col(at["lang"])),
        quoted(source).cast("string").eqNullSafe(F.col(at["source"])),
    ]
    tokens = F.regexp_count(quoted(text), F.lit(WORD_PATTERN)).cast("bigint")
    step = docs.withColumn(at["tokens"], tokens).where(F.col(at["tokens"]) > 0)
    step = step.join(rows, same)
    key = order_key(quoted(id_col), F.col(at["whole"]) + 1, mix.seed)
    epochs = F.col(at["whole"]) + F.when(key <= F.col(at["last"]), 1).otherwise(0)
    step = step.withColumn(
        at["epoch"],
        F.explode(F.filter(F.sequence(F.lit(0).cast("bigint"), epochs), lambda x: x > 0)),
    )
    return step.select(
        *[quoted(c) for c in docs.columns if c != into],
        F.struct(
            F.col(at["domain"]).alias("domain"),
            F.col(at["epoch"]).alias("epoch"),
            F.col(at["tokens"]).alias("n_tokens"),
        ).alias(into),
    )


def op7_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = mix_sources(docs, PRODUCTION)
    return out.select("doc_id", "lang", "source", "mix.domain", "mix.epoch", "mix.n_tokens")


def stage(spark, docs, sf_dir):
    """Documents in the target mix; one that two epochs take stands there twice."""
    out = mix_sources(docs, PRODUCTION, into=fresh("mix"))
    return out.select(*[quoted(c) for c in docs.columns])


def _sql_case(column: str, cases: dict, other) -> str:
    show = lambda x: f"'{x}'" if isinstance(x, str) else str(x)
    whens = " ".join(f"WHEN {show(k)} THEN {show(v)}" for k, v in cases.items())
    return f"CASE {column} {whens} ELSE {show(other)} END" if cases else show(other)


def _sql_share(name: str, nodes: str, parents: str, order: str) -> str:
    part = f"PARTITION BY {parents}" if parents else ""
    return f"""{name}_1 AS (
  SELECT *, most * sum(weight) OVER ({part} ORDER BY most / weight, {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (above - coalesce(sum(most) OVER ({part} ORDER BY most / weight, {order}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled FROM ({nodes})
), {name} AS (
  SELECT {order}, CASE WHEN filled THEN most ELSE greatest(0, weight * (above - coalesce(sum(most) FILTER (filled) OVER ({part}), 0))
    // sum(weight) FILTER (NOT filled) OVER ({part})) END AS given FROM {name}_1
)"""


def _sql(mix: Mix) -> str:
    weight = {level: _sql_case(level, mix.weights.get(level, {}), 1) for level in LEVELS}
    return f"""
WITH units AS (
  SELECT doc_id, {_sql_case("source", mix.domains, mix.other_domain)} AS domain, lang, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) AS BIGINT) AS tokens
  FROM documents WHERE tokens > 0
), leaves AS (
  SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * {mix.max_epochs} AS BIGINT) AS most FROM units GROUP BY ALL
), {_sql_share("by_domain", f"SELECT domain, sum(most) AS most, {weight['domain']} AS weight, (SELECT sum(tokens) * {mix.budget_percent} // 100 FROM leaves) AS above FROM leaves GROUP BY domain", "", "domain")
}, {_sql_share("by_lang", f"SELECT domain, lang, sum(most) AS most, {weight['lang']} AS weight, any_value(given) AS above FROM leaves JOIN by_domain USING (domain) GROUP BY domain, lang", "domain", "domain, lang")
}, {_sql_share("by_source", f"SELECT domain, lang, source, most, {weight['source']} AS weight, given AS above FROM leaves JOIN by_lang USING (domain, lang)", "domain, lang", "domain, lang, source")
}, keyed AS (
  SELECT units.*, CAST(given // leaves.tokens AS BIGINT) AS whole, given % leaves.tokens AS rest,
    md5('{mix.seed}/' || CAST(given // leaves.tokens + 1 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR)) AS key
  FROM units JOIN leaves USING (domain, lang, source) JOIN by_source USING (domain, lang, source)
), taken AS (
  SELECT *, whole + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) <= rest
    THEN 1 ELSE 0 END AS epochs FROM keyed
)
SELECT doc_id, lang, source, domain, epoch, tokens AS n_tokens FROM taken, unnest(range(1, epochs + 1)) AS t(epoch)
"""


ORACLE = _sql(PRODUCTION)
