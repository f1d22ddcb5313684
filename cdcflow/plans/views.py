"""The tables and views of the chain as temporary views, for reports written in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cdcflow.operators.audit import audit
from cdcflow.operators.flatten import flatten_events, flatten_wide
from cdcflow.operators.state import current_state
from cdcflow.operators.trace import trace
from cdcflow.plans.account import POSITIONS
from cdcflow.schema import ARRIVAL
from cdcflow.sources.envelope import drop_tombstones
from cdcflow.sources.lookup import names_from_lookup
from cdcflow.sources.tables import live_view
from cdcflow.streaming.current import read_state, read_wide
from cdcflow.streaming.history import read_audit


def register_views(
    spark: SparkSession,
    changes: DataFrame,
    lookup: DataFrame,
    arrivals: DataFrame | None = None,
    columns: Sequence[str] | None = None,
    prefix: str = "",
) -> list[str]:
    """Register every view of the chain over a change log; returns their names.

    ``account`` (current state), ``account_events`` and ``account_audit`` (history without and with before-images),
    ``account_columns`` (wide state), ``lookup_metadata``, ``trace_events``, ``trace_parsed``, ``trace_arrivals`` and
    ``cdc_trace``. ``prefix`` goes in front of all names, so several chains fit into one session. A view is computed
    when it is read, but for the parsing of changes for ``account_audit``. For live results see ``register_live_views``.
    """
    if arrivals is None:
        arrivals = spark.createDataFrame([], ARRIVAL)
    state = current_state(changes)
    views = {
        "account": state.select("recid", "xmlrecord"),
        "account_events": changes,
        "account_audit": audit(changes),
        "account_columns": flatten_wide(state, lookup, columns or names_from_lookup(lookup, POSITIONS)),
        "trace_events": drop_tombstones(changes),
        "trace_parsed": flatten_events(changes, lookup),
        "trace_arrivals": arrivals,
        "cdc_trace": trace(changes, arrivals),
        "lookup_metadata": lookup,
    }
    for name, df in views.items():
        live_view(df, prefix + name)
    return [prefix + name for name in views]


def register_live_views(spark: SparkSession, state: str, wide: str, history: str, prefix: str = "live_") -> list[str]:
    """Views over live tables, by their folders: ``account``, ``account_columns`` and ``account_audit``.

    They read what ``upsert_stream``, ``flatten_stream`` and ``audit_stream`` have published. A view knows the layers
    of its table at the time it is registered; register again to see later batches.
    """
    views = {
        "account": read_state(spark, state),
        "account_columns": read_wide(spark, wide),
        "account_audit": read_audit(spark, history),
    }
    for name, df in views.items():
        live_view(df, prefix + name)
    return [prefix + name for name in views]
