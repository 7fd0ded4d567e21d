"""Declared schemas shared by batch readers, stream readers and writers."""

from __future__ import annotations

from pyspark.sql import types as T

# Shipment event / shipments table: nine nullable fields, timestamp kept as
# the producer's "yyyy-MM-dd HH:mm:ss" text.
SHIPMENT_SCHEMA = T.StructType(
    [
        T.StructField("shipment_id", T.StringType(), True),
        T.StructField("origin", T.StringType(), True),
        T.StructField("destination", T.StringType(), True),
        T.StructField("vehicle_id", T.StringType(), True),
        T.StructField("weight", T.DoubleType(), True),
        T.StructField("priority", T.StringType(), True),
        T.StructField("revenue", T.DoubleType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
    ]
)
SHIPMENT_COLUMNS = [f.name for f in SHIPMENT_SCHEMA.fields]

# Column added by schema evolution; old rows read NULL.
DELIVERY_RATING = T.StructField("delivery_rating", T.IntegerType(), True)

# Retail order batch checked by the data-quality suite.
RETAIL_ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType(), True),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("quantity", T.IntegerType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("transaction_date", T.StringType(), True),
        T.StructField("customer_email", T.StringType(), True),
    ]
)

# Validation results document: one element per rule, in suite order.
RESULT_ELEMENT = T.StructType(
    [
        T.StructField("success", T.BooleanType(), True),
        T.StructField(
            "expectation_config",
            T.StructType(
                [
                    T.StructField("type", T.StringType(), True),
                    T.StructField("kwargs", T.MapType(T.StringType(), T.StringType()), True),
                ]
            ),
            True,
        ),
        T.StructField(
            "result",
            T.StructType(
                [
                    T.StructField("element_count", T.LongType(), True),
                    T.StructField("missing_count", T.LongType(), True),
                    T.StructField("unexpected_count", T.LongType(), True),
                    T.StructField("unexpected_percent", T.DoubleType(), True),
                ]
            ),
            True,
        ),
    ]
)
RESULTS_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("success", T.BooleanType(), True),
        T.StructField("results", T.ArrayType(RESULT_ELEMENT), True),
    ]
)

# Row-version log: columns beside the payload.
LOG_ROW_ID = "_row_id"
LOG_COMMIT_ID = "_commit_id"
LOG_OP = "_op"
