"""argent: bronze-to-silver cleaning for customer and sales tables on Spark.

Every rule is a built-in Column expression, every stage a
``DataFrame -> DataFrame`` function for ``DataFrame.transform``, and each
pipeline is one lazy plan with a single shuffle (the dedup on the key).
"""

from argent.errors import ETLError, ExtractionError, LoadingError, ProcessingError
from argent.plans.job import bronze_to_silver
from argent.plans.pipelines import customer_pipeline, sales_pipeline
from argent.plans.quality import (
    customer_quality,
    observed_customer_pipeline,
    observed_sales_pipeline,
    sales_quality,
)
from argent.schemas import CustomerColumns, SalesColumns, customer_schema, sales_schema

__all__ = [
    "ETLError",
    "ExtractionError",
    "LoadingError",
    "ProcessingError",
    "CustomerColumns",
    "SalesColumns",
    "customer_schema",
    "sales_schema",
    "customer_pipeline",
    "sales_pipeline",
    "customer_quality",
    "sales_quality",
    "observed_customer_pipeline",
    "observed_sales_pipeline",
    "bronze_to_silver",
]
