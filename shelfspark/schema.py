"""Schemas of the raw files and of the prepared rows."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


RAW_SALES = _struct(
    Store=T.IntegerType(),
    DayOfWeek=T.IntegerType(),
    Date=T.DateType(),
    Sales=T.DoubleType(),
    Customers=T.DoubleType(),
    Open=T.IntegerType(),
    Promo=T.IntegerType(),
    StateHoliday=T.StringType(),
    SchoolHoliday=T.IntegerType(),
)

RAW_STORES = _struct(
    Store=T.IntegerType(),
    StoreType=T.StringType(),
    Assortment=T.StringType(),
    CompetitionDistance=T.DoubleType(),
    CompetitionOpenSinceMonth=T.IntegerType(),
    CompetitionOpenSinceYear=T.IntegerType(),
    Promo2=T.IntegerType(),
    Promo2SinceWeek=T.IntegerType(),
    Promo2SinceYear=T.IntegerType(),
    PromoInterval=T.StringType(),
)

PREPARED_SALES = _struct(
    date=T.DateType(),
    store_id=T.StringType(),
    sales=T.DoubleType(),
    customer_traffic=T.DoubleType(),
    has_promotion=T.IntegerType(),
    is_open=T.IntegerType(),
    state_holiday=T.StringType(),
    school_holiday=T.IntegerType(),
    is_holiday=T.IntegerType(),
    store_type=T.StringType(),
    assortment=T.StringType(),
    competition_distance=T.DoubleType(),
    promo2=T.IntegerType(),
    promo_interval=T.StringType(),
)

HISTORY = _struct(
    **{
        f.name: f.dataType
        for f in PREPARED_SALES.fields
        if f.name != "is_holiday"
    }
)
