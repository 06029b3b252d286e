"""Customer rules and pipeline."""

import pytest
from pyspark.sql import types as T

from argent.errors import ProcessingError
from argent.operators.customers import (
    clean_gender,
    clean_names,
    validate_age,
    validate_customers,
)
from argent.plans.pipelines import customer_pipeline
from argent.schemas import CustomerColumns

SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

# (row, what the pipeline makes of it; None: dropped)
CASES = [
    ((" P-1", "fEmAlE ", 0, " Cheque "), ("P-1", "FEMALE", 0, "Cheque")),
    (("P-2  ", "MALE", 120, None), ("P-2", "MALE", 120, "Unknown")),
    (("P-3", "m", 121, ""), ("P-3", "Other", 0, "Unknown")),
    (("P-4", None, -1, "Cash"), ("P-4", "Other", 0, "Cash")),
    (("P-5", " ", None, "   "), None),  # a copy: 'MALE' sorts before 'Other'
    (("P-5", "male", 40, "Cash"), ("P-5", "MALE", 40, "Cash")),
    (("   ", "male", 40, "Cash"), None),
    (("", "male", 40, "Cash"), None),
    ((None, "male", 40, "Cash"), None),
]
ROWS = [row for row, _ in CASES]
EXPECTED = {want for _, want in CASES if want}


def test_pipeline_rows_and_schema(spark, ansi):
    out = customer_pipeline(spark.createDataFrame(ROWS, SCHEMA))
    assert out.schema == SCHEMA
    assert {tuple(r) for r in out.collect()} == EXPECTED


def test_pipeline_conforms_reordered_text_input(spark, ansi):
    df = spark.createDataFrame(
        [(" C1 ", "41.7", " male ", None, "extra")],
        "customer_id string, age string, gender string, payment_method string, x string",
    )
    out = customer_pipeline(df)
    assert out.columns == ["customer_id", "gender", "age", "payment_method"]
    assert out.schema["age"].dataType == T.IntegerType()
    assert [tuple(r) for r in out.collect()] == [("C1", "MALE", 41, "Unknown")]


def test_pipeline_missing_column_raises(spark):
    df = spark.createDataFrame([("C1", "Male")], "customer_id string, gender string")
    with pytest.raises(ProcessingError, match="age"):
        customer_pipeline(df)


def test_missing_gender_becomes_other(spark):
    df = spark.createDataFrame(
        [("C1", None, 30, "Cash"), ("C2", "", 25, "Cash"), ("C3", "Female", 40, "Cash")],
        "customer_id string, gender string, age long, payment_method string",
    )
    got = {r.customer_id: r.gender for r in clean_gender(df).collect()}
    assert got == {"C1": "Other", "C2": "Other", "C3": "FEMALE"}


def test_gender_absent_column_is_noop(spark):
    df = spark.createDataFrame([("C1",)], "customer_id string")
    assert clean_gender(df, "gender") is df


def test_bad_ages(spark, ansi):
    df = spark.createDataFrame(
        [("C1", -10), ("C2", 200), ("C3", 25), ("C4", None), ("C5", 0), ("C6", 120)],
        "customer_id string, age int",
    )
    got = {r.customer_id: r.age for r in validate_age(df).collect()}
    assert got == {"C1": 0, "C2": 0, "C3": 25, "C4": 0, "C5": 0, "C6": 120}


def test_duplicates_keep_first_by_other_columns(spark):
    df = spark.createDataFrame(
        [
            ("C1", "Male", 30, "Cash"),
            ("C1", "Female", 25, "Credit Card"),
            ("C2", "Male", 40, "Cash"),
            ("C2", "Male", 40, "Cash"),
        ],
        SCHEMA,
    )
    out = {tuple(r) for r in customer_pipeline(df).collect()}
    # Kept row: smallest (gender, age, payment_method) after cleaning.
    assert out == {("C1", "FEMALE", 25, "Credit Card"), ("C2", "MALE", 40, "Cash")}


def test_padded_strings_trimmed(spark):
    df = spark.createDataFrame(
        [("  C1  ", "  Male  ", 30, "  Cash  "), ("  C2  ", "  Female  ", 25, "  Credit Card  ")],
        SCHEMA,
    )
    out = {tuple(r) for r in customer_pipeline(df).collect()}
    assert out == {("C1", "MALE", 30, "Cash"), ("C2", "FEMALE", 25, "Credit Card")}


def test_clean_names(spark):
    df = spark.createDataFrame([(" Ann-Marie! ", "O'Neil")], "first string, last string")
    out = clean_names(df, ["first", "last", "absent"]).first()
    assert (out.first, out.last) == ("AnnMarie", "ONeil")


def test_validate_customers_drops_null_empty_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("C1",)], "customer_id string")
    assert [r.customer_id for r in validate_customers(df).collect()] == ["C1"]


def test_custom_column_names(spark):
    cols = CustomerColumns(customer_id="cid", gender="sex", age="years", payment_method="pay")
    df = spark.createDataFrame([("C1", "male", 30, "")], "cid string, sex string, years int, pay string")
    out = customer_pipeline(df, cols)
    assert out.columns == ["cid", "sex", "years", "pay"]
    assert tuple(out.first()) == ("C1", "MALE", 30, "Unknown")


def test_conform_case_insensitive_and_ambiguous(spark):
    from argent.operators.stages import conform

    df = spark.createDataFrame([("C1", "7")], "CUSTOMER_ID string, Age string")
    schema = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("age", T.IntegerType())])
    out = conform(df, schema)
    assert out.columns == ["customer_id", "age"] and tuple(out.first()) == ("C1", 7)
    both = spark.createDataFrame([("1", "2")], "age string, AGE string")
    with pytest.raises(ProcessingError, match="ambiguous"):
        conform(both, T.StructType([T.StructField("age", T.IntegerType())]))
