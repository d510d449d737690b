"""Explicit schemas of the input files; no inference pass is ever needed.

Money stays text on read and is typed by ``functions.money``. ``date`` is a wall-clock
timestamp, so hours and days do not move with the session time zone. ``zip`` is text to
keep leading zeros.
"""

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRANSACTIONS = _schema(
    id=T.LongType(),
    date=T.TimestampNTZType(),
    client_id=T.LongType(),
    card_id=T.LongType(),
    amount=T.StringType(),
    use_chip=T.StringType(),
    merchant_id=T.LongType(),
    merchant_city=T.StringType(),
    merchant_state=T.StringType(),
    zip=T.StringType(),
    mcc=T.IntegerType(),
    errors=T.StringType(),
)

CARDS = _schema(
    id=T.LongType(),
    client_id=T.LongType(),
    card_number=T.StringType(),
    expires=T.StringType(),
    cvv=T.StringType(),
    has_chip=T.StringType(),
    credit_limit=T.StringType(),
    acct_open_date=T.StringType(),
    year_pin_last_changed=T.IntegerType(),
    card_on_dark_web=T.StringType(),
)

USERS = _schema(
    id=T.LongType(),
    current_age=T.IntegerType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    per_capita_income=T.StringType(),
    yearly_income=T.StringType(),
    total_debt=T.StringType(),
    credit_score=T.IntegerType(),
)

MCC_CODES = _schema(mcc=T.StringType(), merchant_category=T.StringType())

FRAUD_LABELS = _schema(transaction_id=T.LongType(), is_fraud=T.BooleanType())
