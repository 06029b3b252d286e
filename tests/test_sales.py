"""Sales rules and pipeline."""

import datetime as dt
import math

from pyspark.sql import types as T

from argent.operators.sales import (
    clean_category,
    clean_mall_names,
    parse_invoice_date,
    validate_numeric_fields,
    validate_sales,
)
from argent.plans.pipelines import sales_pipeline

SCHEMA = T.StructType(
    [
        T.StructField("invoice_no", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("invoice_date", T.StringType()),
        T.StructField("shopping_mall", T.StringType()),
    ]
)

# (row, what the pipeline makes of it; None: dropped)
D = dt.date
CASES = [
    (("  N-100 ", " K7", " books ", 3, 12.5, "28-02-2023", " Agora "), ("N-100", "K7", "BOOKS", 3.0, 12.5, D(2023, 2, 28), "Agora")),
    (("N-101", "K8", "FOOD & beverage", 0, 0.0, "2023-03-01", "Mall/No 9"), ("N-101", "K8", "FOOD & BEVERAGE", 1.0, 0.0, D(2023, 3, 1), "MallNo 9")),
    (("N-102", "K9", "Garden", -4, -0.01, "31-02-2023", None), ("N-102", "K9", "Other", 1.0, 0.0, None, "Unknown")),
    (("N-103", "K9", None, None, None, None, ""), ("N-103", "K9", "Other", 1.0, 0.0, None, "Unknown")),
    (("N-104", "K9", "electronics", 2, float("nan"), "1-3-2023", "É!"), ("N-104", "K9", "ELECTRONICS", 2.0, 0.0, None, "")),
    (("N-105", "  ", "Books", 1, 1.0, "01-03-2023", "A"), None),
    (("N-106", None, "Books", 1, 1.0, "01-03-2023", "A"), None),
    (("   ", "K1", "Books", 1, 1.0, "01-03-2023", "A"), None),
    ((None, "K1", "Books", 1, 1.0, "01-03-2023", "A"), None),
    (("N-107", "K1", "accessories", 2_000_000, 1e12, "29-02-2024", "a  b"), ("N-107", "K1", "ACCESSORIES", 2e6, 1e12, D(2024, 2, 29), "a  b")),
]
ROWS = [row for row, _ in CASES]
EXPECTED = {want for _, want in CASES if want}


def test_pipeline_rows_dates_and_types(spark, ansi):
    out = sales_pipeline(spark.createDataFrame(ROWS, SCHEMA))
    types = {f.name: f.dataType for f in out.schema.fields}
    # quantity widens to DOUBLE (its fill default is 0.0); dates are parsed.
    assert types["quantity"] == T.DoubleType()
    assert types["invoice_date"] == T.DateType()
    assert {tuple(r) for r in out.collect()} == EXPECTED


def test_cast_first_mode_loses_day_first_dates(spark, ansi):
    out = sales_pipeline(spark.createDataFrame(ROWS, SCHEMA), date_mode="cast_first")
    assert out.count() == len(EXPECTED)
    assert {r.invoice_date for r in out.collect()} == {None, D(2023, 3, 1)}  # only the ISO date


def test_numbers_as_strings(spark, ansi):
    df = spark.createDataFrame(
        [("I1", "C1", "Books", "2", "100.0", "01-01-2022", "Mall")],
        ", ".join(f"{f.name} string" for f in SCHEMA.fields),
    )
    r = sales_pipeline(df).first()
    assert (r.quantity, r.price) == (2.0, 100.0)


def test_bad_quantities_and_prices(spark, ansi):
    df = spark.createDataFrame(
        [(-5, -100.0), (0, 0.0), (3, 50.0), (None, None), (2, float("nan"))],
        "quantity long, price double",
    )
    got = [tuple(r) for r in validate_numeric_fields(df).collect()]
    assert got[:4] == [(1, 0.0), (1, 0.0), (3, 50.0), (None, None)]
    # NaN is not < 0: it stays.
    assert got[4][0] == 2 and math.isnan(got[4][1])


def test_categories(spark):
    df = spark.createDataFrame(
        [("clothing",), ("SHOES",), ("Invalid Category",), (" food & beverage ",), (None,), ("Unknown",)],
        "category string",
    )
    got = [r.category for r in clean_category(df).collect()]
    assert got == ["CLOTHING", "SHOES", "Other", "FOOD & BEVERAGE", "Other", "Other"]


def test_duplicates_keep_first_by_other_columns(spark):
    df = spark.createDataFrame(
        [
            ("I1", "C2", "Books", 1, 10.0, "01-01-2022", "Mall"),
            ("I1", "C1", "Shoes", 2, 20.0, "02-01-2022", "Mall"),
            ("I2", "C3", "Books", 1, 10.0, "01-01-2022", "Mall"),
        ],
        SCHEMA,
    )
    out = {(r.invoice_no, r.customer_id) for r in sales_pipeline(df).collect()}
    assert out == {("I1", "C1"), ("I2", "C3")}


def test_dedup_precedes_validation(spark):
    # The kept row of I1 has an empty customer id, so the invoice vanishes.
    df = spark.createDataFrame(
        [
            ("I1", "", "Books", 1, 10.0, "01-01-2022", "Mall"),
            ("I1", "C1", "Books", 1, 10.0, "01-01-2022", "Mall"),
        ],
        SCHEMA,
    )
    assert sales_pipeline(df).count() == 0


def test_padded_strings_trimmed(spark):
    df = spark.createDataFrame(
        [("  I1  ", "  C1  ", "  Books  ", 1, 10.0, "01-01-2022", "  Kanyon  ")], SCHEMA
    )
    r = sales_pipeline(df).first()
    assert (r.invoice_no, r.customer_id, r.category, r.shopping_mall) == ("I1", "C1", "BOOKS", "Kanyon")


def test_parse_invoice_date_alone_is_strict(spark, ansi):
    texts = ["05-08-2022", "2022", "2022-08-05", "5-8-2022", "31-02-2022", "bad", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "invoice_date string")
    got = [r.invoice_date for r in parse_invoice_date(df).collect()]
    assert got == [D(2022, 8, 5)] + [None] * 7
    iso = [r.invoice_date for r in parse_invoice_date(df, iso_fallback=True).collect()]
    assert iso[:3] == [D(2022, 8, 5), D(2022, 1, 1), D(2022, 8, 5)]
    dated = spark.createDataFrame([(D(2022, 1, 2),)], "invoice_date date")
    assert parse_invoice_date(dated) is dated


def test_mall_names(spark):
    df = spark.createDataFrame([(" Forum-Istanbul! ",), ("İstinye Park",), ("***",), (None,)], "shopping_mall string")
    got = [r.shopping_mall for r in clean_mall_names(df).collect()]
    assert got == ["ForumIstanbul", "stinye Park", "", None]


def test_validate_sales_does_not_trim(spark):
    df = spark.createDataFrame(
        [("I1", " ", 1, 1.0), ("", "C1", 1, 1.0), ("I2", "C2", None, 1.0), ("I3", "C3", 1, None), ("I4", "C4", 1, 1.0)],
        "invoice_no string, customer_id string, quantity int, price double",
    )
    assert [r.invoice_no for r in validate_sales(df).collect()] == ["I1", "I4"]
