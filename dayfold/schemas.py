"""Schemas of the bank warehouse (intended DDL, Spark types) and per-dimension merge specs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, D, TS = StringType(), DateType(), TimestampNTZType()
AMOUNT = DecimalType(18, 2)


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


VALIDITY = (("effective_from", TS), ("effective_to", TS), ("deleted_flg", S))

# Daily drops (columns bound by position, header skipped).
TRANSACTIONS = _schema(
    ("trans_id", S), ("trans_date", TS), ("amt", AMOUNT), ("card_num", S),
    ("oper_type", S), ("oper_result", S), ("terminal", S),
)
TERMINALS = _schema(("terminal_id", S), ("terminal_type", S), ("terminal_city", S), ("terminal_address", S))
BLACKLIST_FILE = _schema(("entry_dt", D), ("passport_num", S))
BLACKLIST = _schema(("passport_num", S), ("entry_dt", D))

FACTS = StructType([*TRANSACTIONS.fields, StructField("trans_day", D, True)])
REJECTS = StructType([*TRANSACTIONS.fields, StructField("bad_cells", ArrayType(S), True)])

# History dimensions (attributes + validity).
DIM_CARDS = _schema(("card_num", S), ("account_num", S), *VALIDITY)
DIM_ACCOUNTS = _schema(("account_num", S), ("valid_to", D), ("client", S), *VALIDITY)
DIM_CLIENTS = _schema(
    ("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S), ("date_of_birth", D),
    ("passport_num", S), ("passport_valid_to", D), ("phone", S), *VALIDITY,
)
DIM_TERMINALS = _schema(("terminal_id", S), ("terminal_type", S), ("terminal_city", S), ("terminal_address", S), *VALIDITY)

REPORT = _schema(
    ("event_dt", TS), ("passport", S), ("fio", S), ("phone", S), ("event_type", S), ("report_dt", D),
)


@dataclass(frozen=True)
class DimSpec:
    """How one history dimension is merged: key, tracked attributes and the source's change timestamps.

    ``created``/``updated`` are None for full snapshots (terminals): the run date then supplies every bound.
    """

    name: str
    key: str
    attrs: tuple[str, ...]
    created: str | None = "create_dt"
    updated: str | None = "update_dt"


CARDS = DimSpec("cards", "card_num", ("account_num",))
ACCOUNTS = DimSpec("accounts", "account_num", ("valid_to", "client"))
CLIENTS = DimSpec(
    "clients", "client_id",
    ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num", "passport_valid_to", "phone"),
)
TERMINALS_DIM = DimSpec("terminals", "terminal_id", ("terminal_type", "terminal_city", "terminal_address"), None, None)
