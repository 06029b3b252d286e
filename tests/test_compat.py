"""The call-compatible classes delegate to the Spark-first functions."""

from argent.compat import (
    CSVExtractor,
    CustomerProcessor,
    DeltaLoader,
    ParquetExtractor,
    SalesProcessor,
)
from argent.plans.bronze import bronze_customers, bronze_sales
from argent.plans.staging import stage_csv, stage_parquet

from conftest import SF_SMALL


def test_flow_through_compatible_classes(spark, workdir):
    customers_src = stage_parquet(bronze_customers(spark, SF_SMALL), "t-compat-customers")
    sales_src = stage_csv(bronze_sales(spark, SF_SMALL), "t-compat-sales")
    loader = DeltaLoader(spark, mode="overwrite")

    customers = CustomerProcessor().process(ParquetExtractor(spark).extract(customers_src))
    loader.load(customers, f"{workdir}/customers")
    assert spark.read.parquet(f"{workdir}/customers").count() == 129

    raw = CSVExtractor(spark, header=True, infer_schema=False).extract_with_validation(
        sales_src, expected_columns=["invoice_no", "price"], min_rows=10
    )
    sales = SalesProcessor().process(raw)
    loader.load(sales, f"{workdir}/sales")
    assert spark.read.parquet(f"{workdir}/sales").count() == sales.count()


def test_single_rule_methods(spark):
    proc = SalesProcessor()
    df = proc.apply_schema(bronze_sales(spark, SF_SMALL))
    df = proc.trim_string_columns(df, proc.columns.get_string_columns())
    df = proc.handle_missing_values(df, ["category"], ["quantity", "price"])
    df = proc.clean_shopping_mall_names(proc.clean_category(proc.validate_numeric_fields(df)))
    df = proc.validate_sales_data(proc.remove_duplicates(proc.process_invoice_date(df), ["invoice_no"]))
    assert df.count() == SalesProcessor().process(bronze_sales(spark, SF_SMALL)).count()

    cp = CustomerProcessor()
    c = cp.apply_schema(bronze_customers(spark, SF_SMALL))
    c = cp.validate_customer_data(cp.validate_age(cp.validate_and_clean_gender(c)))
    assert c.filter("age < 0 OR age > 120").count() == 0
    assert cp.clean_customer_names(c, ["customer_id"]).count() == c.count()


def test_loader_table_and_unavailable_delta(spark, workdir):
    import pytest

    from argent.errors import LoadingError

    spark.sql(f"CREATE DATABASE IF NOT EXISTS argent_compat_db LOCATION '{workdir}/wh'")
    df = spark.createDataFrame([("A", 1)], "name string, n int")
    DeltaLoader(spark).load_as_table(df, "people", database="argent_compat_db")
    assert spark.table("argent_compat_db.people").count() == 1
    spark.sql("DROP TABLE argent_compat_db.people")
    # The Delta jar is not installed here: the loader fails before any work.
    with pytest.raises(LoadingError, match="not available"):
        DeltaLoader(spark, fmt="delta").load(df, f"{workdir}/delta_out")


def test_role_names_and_protocols(spark):
    from argent import compat

    c, s = compat.CustomerProcessor().columns, compat.SalesProcessor().columns
    assert c.get_duplicate_key_columns() == ["customer_id"] and s.get_duplicate_key_columns() == ["invoice_no"]
    assert c.get_string_columns() == ["customer_id", "gender", "payment_method"] and c.get_numeric_columns() == ["age"]
    assert s.get_string_columns() == ["invoice_no", "customer_id", "category", "shopping_mall"]
    assert s.get_numeric_columns() == ["quantity", "price"]
    assert compat.CustomerColumns(age="years").to_dict() == {
        "customer_id": "customer_id", "gender": "gender", "age": "years", "payment_method": "payment_method"
    }

    class Own:  # a class of one's own fits by its methods
        def process(self, df):
            return df

    step: compat.IBaseProcessor = Own()
    assert step.process(spark.range(1)).count() == 1
    for proto, method in ((compat.IBaseExtractor, "extract"), (compat.IBaseLoader, "load")):
        assert hasattr(proto, method)
