"""Column names and types shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the point-of-sale database.
SALE_COLUMNS = {"Codigo": "sale_id", "Data": "sold_at"}
LINE_COLUMNS = {
    "CodigoVenda": "sale_id",
    "CodigoProduto": "product_code",
    "CodigoBarras": "barcode",
    "PrecoemPromocao": "on_promotion",
    "Quantidade": "quantity",
    "QuantDevolvida": "returned_quantity",
    "ValorUnitario": "unit_value",
    "ValorCusto": "cost_value",
    "Desconto": "discount",
    "Acrescimo": "increase",
}
PRODUCT_COLUMNS = {"Codigo": "product_code", "CodigoBarras": "barcode"}
SCORE_COLUMNS = {"CodigoProduto": "product_code", "Representatividade": "score"}

# Column names of the exported daily series.
EXPORT_COLUMNS = {
    "date": "Date",
    "barcode": "Barcode",
    "on_promotion": "OnPromotion",
    "quantity": "Quantity",
    "returned_quantity": "ReturnedQuantity",
    "discount": "Discount",
    "increase": "Increase",
    "total_value": "TotalValue",
    "unit_value": "UnitValue",
    "cost_value": "CostValue",
    "holiday": "Holiday",
}

SALES = T.StructType([T.StructField("sale_id", T.LongType()), T.StructField("sold_at", T.TimestampNTZType())])

LINES = T.StructType(
    [
        T.StructField("sale_id", T.LongType()),
        T.StructField("product_code", T.LongType()),
        T.StructField("barcode", T.StringType()),
        T.StructField("on_promotion", T.IntegerType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("returned_quantity", T.DoubleType()),
        T.StructField("unit_value", T.DoubleType()),
        T.StructField("cost_value", T.DoubleType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("increase", T.DoubleType()),
    ]
)

PRODUCTS = T.StructType([T.StructField("product_code", T.LongType()), T.StructField("barcode", T.StringType())])

# A product file as written by the export, one row per day.
SERIES_FILE = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Barcode", T.StringType()),
        T.StructField("OnPromotion", T.IntegerType()),
        T.StructField("Quantity", T.DoubleType()),
        T.StructField("ReturnedQuantity", T.DoubleType()),
        T.StructField("Discount", T.DoubleType()),
        T.StructField("Increase", T.DoubleType()),
        T.StructField("TotalValue", T.DoubleType()),
        T.StructField("UnitValue", T.DoubleType()),
        T.StructField("CostValue", T.DoubleType()),
        T.StructField("Holiday", T.IntegerType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("barcode", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("real", T.DoubleType()),
        T.StructField("forecast", T.DoubleType()),
    ]
)

LAGS = (1, 7, 14, 21, 30)

# Model inputs in column order. The barcode is a key, not an input.
FEATURES = (
    "on_promotion",
    "returned_quantity",
    "discount",
    "increase",
    "unit_value",
    "cost_value",
    "holiday",
    "day_of_week",
    "month",
    "is_weekend",
    "holiday_lag_1",
    "lag_1",
    "lag_7",
    "lag_14",
    "lag_21",
    "lag_30",
    "rolling_mean_7",
    "rolling_std_7",
    "promo_lag_1",
    "discount_rate",
    "increase_rate",
    "returned_rate",
    "profit_margin",
    "day_of_year",
    "week_of_year",
    "start_month",
    "end_month",
    "dow_sin",
    "dow_cos",
    "m_sin",
    "m_cos",
)

# Without the returns of the forecast day itself, which are not known in advance.
SAFE_FEATURES = tuple(c for c in FEATURES if c != "returned_quantity")
