"""Declared schemas of the input and derived tables, by business area.

Whole-number keys are ``LongType``. ``NUMBER`` is a 38-digit number without a scale, so fractions are
rounded half-up when a text field is loaded into it.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VarcharType,
)

KEY = LongType()
TEXT = StringType()
SHORT_TEXT = VarcharType(255)
NUMBER = DecimalType(38, 0)
MONEY = DecimalType(10, 2)
DATE = DateType()


def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


# Agriculture: raw and staging tables share each shape.
CROP_DATA = table(
    crop_id=KEY,
    crop_name=TEXT,
    state=TEXT,
    district=TEXT,
    year=KEY,
    production_tonnes=NUMBER,
    area_hectares=NUMBER,
)
FARMER_DATA = table(farmer_id=KEY, name=TEXT, district=TEXT, land_area_acres=NUMBER)
RAINFALL_DATA = table(record_id=KEY, district=TEXT, year=KEY, rainfall_mm=NUMBER)
SOIL_DATA = table(
    soil_id=KEY,
    district=TEXT,
    soil_type=TEXT,
    ph_level=NUMBER,
    nitrogen=NUMBER,
    phosphorus=NUMBER,
    potassium=NUMBER,
)
FERTILIZER_DATA = table(
    fertilizer_id=KEY, district=TEXT, fertilizer_type=TEXT, quantity_used_kg=NUMBER
)

# Customer orders.
CUSTOMERS = table(customer_id=KEY, name=TEXT, city=TEXT)
ORDERS = table(order_id=KEY, customer_id=KEY, amount=KEY, order_date=DATE)
CUSTOMER_SUMMARY = table(
    customer_id=KEY, name=TEXT, city=TEXT, total_orders=KEY, total_spent=KEY
)

# Personal finance.
TRANSACTIONS_RAW = table(
    transaction_id=NUMBER,
    txn_date=DATE,
    description=TEXT,
    amount=MONEY,
    type=TEXT,
    category=TEXT,
)
TRANSACTIONS = StructType(
    TRANSACTIONS_RAW.fields + table(month_name=TEXT, year=NUMBER).fields
)

# Retail.
RAW_CUSTOMERS = table(
    customer_id=SHORT_TEXT, customer_name=SHORT_TEXT, email=SHORT_TEXT, city=SHORT_TEXT
)
RAW_INVENTORY = table(
    inventory_id=SHORT_TEXT, product_id=SHORT_TEXT, store_id=SHORT_TEXT, stock_qty=KEY
)
RAW_PRODUCT = table(
    product_id=SHORT_TEXT, product_name=SHORT_TEXT, category=SHORT_TEXT, unit_price=KEY
)
RAW_STORES = table(store_id=SHORT_TEXT, store_name=SHORT_TEXT, location=SHORT_TEXT)
RAW_ORDERS = table(
    order_id=KEY,
    customer_id=SHORT_TEXT,
    product_id=SHORT_TEXT,
    store_id=SHORT_TEXT,
    qty=KEY,
    price=KEY,
    order_date=DATE,
)
FACT_SALES = table(
    order_id=KEY,
    customer_id=SHORT_TEXT,
    product_id=SHORT_TEXT,
    store_id=SHORT_TEXT,
    qty=KEY,
    sales_amount=KEY,
    order_date=DATE,
)

# Usage metering and the task run log.
METERING_HISTORY = table(
    start_time=TimestampType(), warehouse_name=TEXT, credits_used=DecimalType(38, 9)
)
RUN_LOG = table(
    name=TEXT,
    state=TEXT,
    scheduled_time=TimestampType(),
    query_id=TEXT,
    error_message=TEXT,
)


def with_scale(schema: StructType, numeric_scale: int | None) -> StructType:
    """The schema with every unscaled decimal given ``numeric_scale`` fraction digits."""
    if numeric_scale is None:
        return schema

    def rescaled(dtype: DataType) -> DataType:
        if isinstance(dtype, DecimalType) and dtype.scale == 0:
            return DecimalType(dtype.precision, numeric_scale)
        return dtype

    return StructType([StructField(f.name, rescaled(f.dataType)) for f in schema])


def frame_schema(schema: StructType) -> StructType:
    """The schema a DataFrame of such rows has: length-limited text is plain text there."""
    return StructType(
        [
            StructField(f.name, TEXT if isinstance(f.dataType, VarcharType) else f.dataType)
            for f in schema
        ]
    )


def is_whole_number(dtype: DataType) -> bool:
    return isinstance(dtype, IntegralType)
