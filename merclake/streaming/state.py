"""What streams keep in a ledger: events, each once, and the state of orders.

Of orders every batch adds its facts, and buckets with many of them are folded. Reading costs a row per order and a bounded number of batches since a bucket was last folded, however many messages an
order had. A batch rewrites nothing; a bucket is rewritten once in ``fold`` batches. The offsets are committed after the
handler, and the ledger notes the last batch of each query, so a batch that runs again after a crash adds nothing.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

from merclake.session import materialize
from merclake.sources.keyed import Keyed, insert_new, outgrown, regrow
from merclake.sources.ledger import Change, Ledger, State, bucket_of
from merclake.streaming.events import Handler, merge_facts, order_facts, order_state

TABLE = "order_facts"


def _of_bucket(folder: str) -> int:
    return int(folder.rsplit("bucket=", 1)[1])


def fold_facts(ledger: Ledger, state: State, fold: int) -> State:
    """Merge the facts of buckets that have more than ``fold`` folders, each into one folder, and commit that."""
    counts = Counter(map(_of_bucket, state.tables.get(TABLE, [])))
    crowded = sorted(b for b, n in counts.items() if n > fold)
    if not crowded:
        return state
    rows = ledger.read(TABLE, state=state, buckets=crowded)
    merged = merge_facts(rows, by=["bucket"])
    change = ledger.write(TABLE, merged.select(*rows.columns), by_bucket=True)
    change.drop = {TABLE: ledger.folders(TABLE, state, crowded)}
    return ledger.commit(state, change)


def keep_order_facts(ledger: Ledger, query: str = "orders", buckets: int = 64, fold: int = 8) -> Handler:
    """Handler of order events for :func:`merclake.streaming.events.consume`."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        state = ledger.state()
        done = state.notes.get(f"batch-{query}", -1)
        if batch_id <= done:
            return
        facts = materialize(order_facts(batch)).withColumn("bucket", bucket_of(["order_number"], buckets))
        change = ledger.write(TABLE, facts, by_bucket=True)
        state = ledger.commit(state, change.also(Change(notes={f"batch-{query}": batch_id})))
        fold_facts(ledger, state, fold)

    return handle


def keep_new(ledger: Ledger, spec: Keyed, query: str) -> Handler:
    """Handler that stores every key once, however late or often it comes. The index of the keys tells new ones, so a
    batch reads about two bytes for each stored key of its buckets, and key columns only where a key may be known."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        state = ledger.state()
        if batch_id <= state.notes.get(f"batch-{query}", -1):
            return
        change, _ = insert_new(ledger, state, spec, batch)
        state = ledger.commit(state, change.also(Change(notes={f"batch-{query}": batch_id})))
        if outgrown(state, spec):
            regrow(ledger, state, spec)

    return handle


def stored_facts(ledger: Ledger) -> DataFrame:
    """One row of facts per order."""
    return merge_facts(ledger.read(TABLE))


def stored_order_state(ledger: Ledger) -> DataFrame:
    return order_state(stored_facts(ledger))
