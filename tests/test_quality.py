"""Quality reports against the documented checkpoints, and the observe path."""

from argent.plans.bronze import bronze_customers, bronze_sales
from argent.plans.pipelines import customer_pipeline, sales_pipeline
from argent.plans.quality import (
    CUSTOMER_COUNTERS,
    SALES_COUNTERS,
    customer_quality,
    observed_customer_pipeline,
    observed_sales_pipeline,
    sales_quality,
)

from conftest import SF_SMALL

# Checkpoints at sf0.001 (computed independently in DuckDB).
CUSTOMER_SF0001 = dict(rows_in=150, invalid_genders=63, invalid_ages=41,
                       duplicates_removed=19, invalid_customers=2, rows_out=129)
SALES_SF0001 = dict(rows_in=6000, duplicates_removed=1480, null_invoice_dates=1003,
                    invalid_quantities=1902, invalid_prices=602, invalid_categories=1975)


def test_customer_quality_checkpoint(spark):
    rep = customer_quality(bronze_customers(spark, SF_SMALL)).first().asDict()
    assert list(rep) == list(CUSTOMER_COUNTERS)
    assert rep == CUSTOMER_SF0001


def test_sales_quality_checkpoint(spark):
    bronze = bronze_sales(spark, SF_SMALL)
    rep = sales_quality(bronze).first().asDict()
    assert list(rep) == list(SALES_COUNTERS)
    assert {k: rep[k] for k in SALES_SF0001} == SALES_SF0001
    out = sales_pipeline(bronze).count()
    assert rep["rows_out"] == out
    assert rep["invalid_sales"] == rep["rows_in"] - rep["duplicates_removed"] - out


def test_sales_quality_cast_first_dates(spark):
    rep = sales_quality(bronze_sales(spark, SF_SMALL), date_mode="cast_first").first()
    assert rep.null_invoice_dates == 5653


def test_observed_pipelines_match_reports(spark):
    df, obs = observed_customer_pipeline(bronze_customers(spark, SF_SMALL))
    df.write.format("noop").mode("overwrite").save()
    assert obs.report() == CUSTOMER_SF0001

    df, obs = observed_sales_pipeline(bronze_sales(spark, SF_SMALL))
    df.write.format("noop").mode("overwrite").save()
    rep = sales_quality(bronze_sales(spark, SF_SMALL)).first().asDict()
    assert obs.report() == rep


def test_observed_pipeline_output_unchanged(spark):
    df, _ = observed_customer_pipeline(bronze_customers(spark, SF_SMALL))
    plain = customer_pipeline(bronze_customers(spark, SF_SMALL))
    assert df.exceptAll(plain).count() == 0 and plain.exceptAll(df).count() == 0


def test_empty_input_reports_zeros(spark):
    empty = bronze_customers(spark, SF_SMALL).limit(0)
    assert customer_quality(empty).first().asDict() == {k: 0 for k in CUSTOMER_COUNTERS}


def test_quality_checkpoints_sf01(spark):
    """The documented sf0.1 checkpoints (15,000 customers, 600,000 sales)."""
    d = "/root/testdata/sf0.1"
    cust = customer_quality(bronze_customers(spark, d)).first().asDict()
    assert cust == dict(rows_in=15000, invalid_genders=6428, invalid_ages=4091,
                        duplicates_removed=2098, invalid_customers=2, rows_out=12900)
    sales = sales_quality(bronze_sales(spark, d)).first().asDict()
    assert sales == dict(rows_in=600000, duplicates_removed=150219, null_invoice_dates=94730,
                         invalid_quantities=184866, invalid_prices=35442,
                         invalid_categories=199877, invalid_sales=14537, rows_out=435244)
