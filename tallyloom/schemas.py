"""Column names and types of the raw sources and of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PERCENT = T.DecimalType(18, 1)
DISCOUNT = T.DecimalType(9, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_text, _int, _long, _real = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_date, _bool, _time = T.DateType(), T.BooleanType(), T.TimestampType()

# Raw sources: dates stay text until cleaning, so that a bad date is a cleaning
# matter and not a scan failure.
RAW = {
    "orders": _struct(
        order_id=_text,
        customer_id=_text,
        product_id=_text,
        quantity=_int,
        unit_price=_real,
        discount_pct=_real,
        order_date=_text,
        status=_text,
    ),
    "customers": _struct(
        customer_id=_text,
        name=_text,
        email=_text,
        region=_text,
        city=_text,
        segment=_text,
        signup_date=_text,
    ),
    "products": _struct(
        product_id=_text,
        name=_text,
        category=_text,
        subcategory=_text,
        brand=_text,
        supplier_id=_text,
        cost_price=_real,
        retail_price=_real,
    ),
    "suppliers": _struct(
        supplier_id=_text,
        name=_text,
        country=_text,
        lead_time_days=_int,
        reliability_rating=_real,
    ),
    "returns": _struct(return_id=_text, order_id=_text, return_date=_text, reason=_text),
    "shipping": _struct(
        order_id=_text,
        carrier=_text,
        shipped_date=_text,
        delivered_date=_text,
        shipping_cost=_real,
    ),
}

STAR = {
    "dim_date": _struct(
        date_key=_int,
        full_date=_date,
        year=_int,
        quarter=_int,
        month=_int,
        month_name=_text,
        week=_int,
        day_of_week=_int,
        day_name=_text,
        is_weekend=_bool,
        fiscal_quarter=_text,
    ),
    "dim_customer": _struct(
        customer_key=_long,
        customer_id=_text,
        name=_text,
        email=_text,
        region=_text,
        city=_text,
        segment=_text,
        signup_date=_date,
    ),
    "dim_supplier": _struct(
        supplier_key=_long,
        supplier_id=_text,
        name=_text,
        country=_text,
        lead_time_days=_int,
        reliability_rating=_real,
    ),
    "dim_product": _struct(
        product_key=_long,
        product_id=_text,
        name=_text,
        category=_text,
        subcategory=_text,
        brand=_text,
        supplier_key=_long,
        cost_price=MONEY,
        retail_price=MONEY,
        margin_pct=PERCENT,
    ),
    "fact_sales": _struct(
        order_key=_long,
        order_id=_text,
        date_key=_int,
        customer_key=_long,
        product_key=_long,
        supplier_key=_long,
        quantity=_int,
        unit_price=MONEY,
        discount_pct=DISCOUNT,
        total_amount=MONEY,
        shipping_cost=MONEY,
        profit_margin=PERCENT,
        is_returned=_bool,
    ),
}

# Business key of each dimension: the merge key of incremental loads.
BUSINESS_KEYS = {
    "dim_date": "date_key",
    "dim_supplier": "supplier_id",
    "dim_customer": "customer_id",
    "dim_product": "product_id",
}
SURROGATE_KEYS = {
    "dim_supplier": "supplier_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
}

AGG_DAILY_SALES = _struct(
    date=_date,
    total_revenue=T.DecimalType(38, 2),
    total_orders=_long,
    avg_order_value=_real,
    unique_customers=_long,
)
QUALITY_ISSUES = _struct(
    source=_text, row_index=_long, field=_text, value=_text, rule=_text, message=_text
)
LOAD_METADATA = _struct(
    table_name=_text, last_load_at=_text, records_processed=_long, load_mode=_text
)
RUN_EVENTS = _struct(
    run_id=_long,
    event=_text,
    at=_time,
    mode=_text,
    status=_text,
    error_message=_text,
    quality_score=_real,
    phase_timings=T.MapType(_text, _real),
    row_counts=T.MapType(_text, _long),
)
