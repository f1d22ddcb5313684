"""The wide account view and the typed virtual columns of the account table.

The column names of the view come from the loaded lookup; nothing here repeats them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cdcflow.operators.flatten import flatten_wide, virtual_columns
from cdcflow.sources.lookup import names_from_lookup

# Fields whose elements repeat, and how many columns each has; the lookup file says neither.
POSITIONS = {"c46": 9, "c47": 23, "c48": 23, "c49": 23, "c50": 23, "c99": 3, "c100": 2, "c249": 2, "c250": 2}

# Virtual columns as name, field, type.
ACCOUNT_VIRTUAL = (
    ("currency", "c8", "varchar(250)"),
    ("co_code", "c252", "varchar(250)"),
    ("category", "c2", "decimal(38,0)"),
    ("customer", "c1", "decimal(38,0)"),
    ("mnemonic", "c6", "varchar(250)"),
    ("curr_no", "c248", "varchar(250)"),
    ("posting_restrict", "c13", "varchar(250)"),
    ("opening_date", "c78", "varchar(250)"),
    ("int_no_booking", "c17", "varchar(250)"),
)


def account_view(records: DataFrame, lookup: DataFrame, positions: int | dict[str, int] = POSITIONS) -> DataFrame:
    """``recid`` and a column for every name of the lookup."""
    return flatten_wide(records, lookup, names_from_lookup(lookup, positions))


def account_virtual_columns(records: DataFrame) -> DataFrame:
    return virtual_columns(records, ACCOUNT_VIRTUAL)
