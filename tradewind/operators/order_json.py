"""The free JSON of order documents (tags, feedback, context) with types.

The tables keep these fields as the text that arrived. Here they are VARIANT columns, which
can be stored as Parquet, so that fields are read by path and no text is parsed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import is_unparsed, texts_of, to_variant, value_at

#: The fields of a document, and what the columns are called in the table of orders.
FIELDS = {"tags": "tags", "feedback": "feedback_data", "context": "context_data"}


def with_variants(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The rows with VARIANT columns, each the parsed text of another column.

    ``unparsed`` lists the new columns whose text is there but cannot be parsed, so that
    null never hides one. Where a new column has the name of a text, it takes its place.
    """
    texts = {new: F.col(old) for new, old in columns.items()}
    parsed = {new: to_variant(text) for new, text in texts.items()}
    failed = [F.when(is_unparsed(texts[c], parsed[c]), F.lit(c)) for c in columns]
    return rows.withColumns(parsed | {"unparsed": F.array_compact(F.array(*failed))})


def order_json(orders: DataFrame) -> DataFrame:
    """(order_id, seller_id, tags, feedback, context, unparsed) of flattened orders."""
    texts = orders.select(F.col("id").alias("order_id"), "seller_id", *FIELDS.values())
    return with_variants(texts, FIELDS).select("order_id", "seller_id", *FIELDS, "unparsed")


def with_fields(
    rows: DataFrame, variant: str, fields: dict[str, tuple[str, str]]
) -> DataFrame:
    """The rows with typed columns, each given as (path, type) in a VARIANT column."""
    return rows.withColumns(
        {name: value_at(F.col(variant), *at) for name, at in fields.items()}
    )


def order_tags(parsed: DataFrame) -> DataFrame:
    """(order_id, seller_id, tag): each tag of an order once; orders without tags have no row."""
    tags = F.array_distinct(texts_of(F.col("tags")))
    return parsed.select("order_id", "seller_id", F.explode(tags).alias("tag"))


def tag_counts(parsed: DataFrame) -> DataFrame:
    """Orders per seller and tag; counted before the shuffle, so a hot seller is no hot task."""
    return order_tags(parsed).groupBy("seller_id", "tag").agg(F.count("*").alias("n_orders"))
