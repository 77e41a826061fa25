"""Rejected orders once more: open entries of the quarantine, as they came or corrected."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators.quarantine import ENTRY
from tradewind.plans.orders_run import Request, Seen, order_changes
from tradewind.plans.staging import staging
from tradewind.plans.tables import TableStore
from tradewind.sources.landing import ARRIVAL, CORRUPT

CORRECTIONS = "entry STRING, document STRING"


def replay_orders(
    store: TableStore, run_id: str, as_of: str | dt.datetime, corrections: DataFrame | None = None
) -> bool:
    """Load open entries again; False if there are none, or this run was loaded before.

    ``corrections`` has (``entry``, ``document``): which entries to load and the text to load in place of what
    came, which is taken again where the text is null.  Without corrections all entries are loaded as they came.
    Of several corrections of an entry the greatest text counts; those of an entry that is not open are
    left out.

    A document keeps the arrival of its entry, so a copy that came later still wins.  What is loaded
    closes its entry, whatever id a correction gives it; what is rejected again stays open with one more
    attempt.  The progress of sellers stays as it is.  Stored orders of a paused seller are skipped as in any run.
    """
    store.refresh()
    with staging(store.spark) as stage:
        if store.has_run(run_id):
            return False
        entries, text = store.read("quarantine_open"), F.col("raw_json")
        if corrections is not None:
            given = corrections.groupBy("entry").agg(F.max("document").alias("document"))
            entries, text = entries.join(given, "entry"), F.coalesce("document", "raw_json")
        document = F.from_json(
            text, f"{schemas.RAW_ORDER}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT}
        )
        again = entries.select(
            document.alias("_given"), F.col("entry").alias(ENTRY), F.col("arrived").alias(ARRIVAL)
        ).select("_given.*", ENTRY, ARRIVAL)
        documents = stage.put("replayed", again)
        if documents.isEmpty():
            return False
        changes = order_changes(store, stage, documents, Request(run_id, as_of), ARRIVAL, Seen())
        del changes["etl_state"]
        return store.commit(run_id, changes)
