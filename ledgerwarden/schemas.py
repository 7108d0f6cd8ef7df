"""Schemas of feeds, history, facts and the report, and fixed values.

All timestamps are ``timestamp_ntz``: the reference stores zone-less
``timestamp(0)`` and compares it with dates at midnight, which is what
``timestamp_ntz`` does in Spark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# Fixed values that must equal the reference's for equal results.
FAR_FUTURE = dt.datetime(9999, 12, 31)          # open end of a version
FLAG_LIVE = "N"                                  # delete_flg of a live version
FLAG_DELETED = "Y"                               # delete_flg of a deletion marker
OPER_WITHDRAW = "WITHDRAW"
OPER_PAYMENT = "PAYMENT"
RESULT_SUCCESS = "SUCCESS"
RESULT_REJECT = "REJECT"
EVENT_PASSPORT = "1"      # expired or blacklisted passport
EVENT_ACCOUNT = "2"       # inactive account
EVENT_CITIES = "3"        # different cities within an hour
EVENT_GUESSING = "4"      # amount guessing
SEED_WATERMARK_CARDS = dt.datetime(1900, 1, 1)
SEED_WATERMARK_ACCOUNTS = dt.datetime(1899, 12, 31)
SEED_WATERMARK_CLIENTS = dt.datetime(1899, 12, 31)
SEED_REPORT_DATE = dt.date(2021, 3, 1)

S = T.StringType()
TS = T.TimestampNTZType()
D = T.DateType()
AMOUNT = T.DecimalType(38, 10)   # 28 digits before the point, 10 behind; `feeds.amount_audit` counts what does not fit


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Feeds as landed.
CARDS_SOURCE = _schema(("card_num", S), ("account", S), ("create_dt", TS), ("update_dt", TS))
ACCOUNTS_SOURCE = _schema(("account", S), ("valid_to", D), ("client", S),
                          ("create_dt", TS), ("update_dt", TS))
CLIENTS_SOURCE = _schema(("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
                         ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
                         ("phone", S), ("create_dt", TS), ("update_dt", TS))
TERMINALS_FEED = _schema(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                         ("terminal_address", S))
BLACKLIST_FEED = _schema(("entry_dt", D), ("passport_num", S))
# The transaction text file is read as strings; ``sources.feeds.clean_transactions`` types it.
TRANSACTIONS_RAW = _schema(("transaction_id", S), ("transaction_date", S), ("amount", S),
                           ("card_num", S), ("oper_type", S), ("oper_result", S), ("terminal", S))

# Warehouse tables.
SCD2_COLUMNS = (("effective_from", TS), ("effective_to", TS), ("delete_flg", S))
TERMINALS_HIST = _schema(*[(f.name, f.dataType) for f in TERMINALS_FEED.fields], *SCD2_COLUMNS)
CARDS_HIST = _schema(("card_num", S), ("account_num", S), *SCD2_COLUMNS)
ACCOUNTS_HIST = _schema(("account_num", S), ("valid_to", D), ("client", S), *SCD2_COLUMNS)
CLIENTS_HIST = _schema(("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
                       ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
                       ("phone", S), *SCD2_COLUMNS)
TRANSACTIONS_FACT = _schema(("trans_id", S), ("trans_date", TS), ("card_num", S), ("oper_type", S),
                            ("amt", AMOUNT), ("oper_result", S), ("terminal", S))
BLACKLIST_FACT = _schema(("passport_num", S), ("entry_dt", D))
REPORT = _schema(("event_dt", TS), ("passport", S), ("fio", S), ("phone", S),
                 ("event_type", S), ("report_dt", D))

# Dimension specs: key, tracked attributes, and the source -> history renames.
DIMENSIONS = {
    "cards": {"key": ["card_num"], "tracked": ["account_num"], "rename": {"account": "account_num"},
              "hist": CARDS_HIST},
    "accounts": {"key": ["account_num"], "tracked": ["valid_to", "client"],
                 "rename": {"account": "account_num"}, "hist": ACCOUNTS_HIST},
    "clients": {"key": ["client_id"],
                "tracked": ["last_name", "first_name", "patronymic", "date_of_birth",
                            "passport_num", "passport_valid_to", "phone"],
                "rename": {}, "hist": CLIENTS_HIST},
    "terminals": {"key": ["terminal_id"],
                  "tracked": ["terminal_type", "terminal_city", "terminal_address"],
                  "rename": {}, "hist": TERMINALS_HIST},
}
