"""The change-data table (M5): key f_id, every column NOT NULL."""

from pyspark.sql import types as T

ID = T.DecimalType(20, 0)
AMOUNT = T.DecimalType(36, 18)

# fixed values: column names and types of the table
ASSET_RECORD = T.StructType([
    T.StructField("f_id", ID, False),
    T.StructField("f_order_id", ID, False),
    T.StructField("f_seq_id", ID, False),
    T.StructField("f_user_id", ID, False),
    T.StructField("f_symbol", T.StringType(), False),
    T.StructField("f_type", T.ShortType(), False),
    T.StructField("f_action", T.ShortType(), False),
    T.StructField("f_amount", AMOUNT, False),
    T.StructField("f_available", AMOUNT, False),
    T.StructField("f_hold", AMOUNT, False),
    T.StructField("f_intra_delta", AMOUNT, False),
    T.StructField("f_fee", AMOUNT, False),
    T.StructField("f_version", ID, False),
    T.StructField("f_created_at", ID, False),
])
ASSET_KEY = "f_id"
