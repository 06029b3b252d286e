"""Call-compatible classes for code written against the class-based API of
the source flow (extractors, processors, loader).

Each method delegates to the Spark-first functions of this package; nothing
here adds logic. Fixed values: class, method and parameter names. Differences: the loader's format defaults to Parquet
(``fmt="delta"`` where the Delta jar is installed), ``process`` is lazy (no
counting actions), and a kept duplicate is deterministic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from argent import schemas
from argent.operators import customers as cust
from argent.operators import sales as sal
from argent.operators.stages import conform, dedup, fill_missing, trim_strings
from argent.plans.pipelines import customer_pipeline, sales_pipeline
from argent.sinks.writers import write_path, write_table
from argent.sources.scans import (
    read_csv,
    read_csv_validated,
    read_parquet,
    read_parquet_validated,
)


class IBaseExtractor(Protocol):
    def extract(self, file_path: str) -> DataFrame: ...


class IBaseProcessor(Protocol):
    def process(self, df: DataFrame) -> DataFrame: ...


class IBaseLoader(Protocol):
    def load(self, df: DataFrame, destination: str) -> None: ...


class _RoleNames:
    """The declared roles under the names that callers use."""

    def to_dict(self) -> dict[str, str]:
        return asdict(self)

    def get_string_columns(self) -> list[str]:
        return self.having(schemas.TEXT)

    def get_numeric_columns(self) -> list[str]:
        return self.having(schemas.NUMBER)

    def get_duplicate_key_columns(self) -> list[str]:
        return self.having(schemas.KEY)


class CustomerColumns(_RoleNames, schemas.CustomerColumns):
    pass


class SalesColumns(_RoleNames, schemas.SalesColumns):
    pass


class CSVExtractor:
    def __init__(
        self,
        spark: SparkSession,
        header: bool = True,
        infer_schema: bool = True,
        delimiter: str = ",",
        schema: T.StructType | None = None,
        options: Mapping[str, Any] | None = None,
    ):
        self.spark = spark
        self.kwargs = dict(
            header=header, infer_schema=infer_schema, delimiter=delimiter,
            schema=schema, options=dict(options or {}),
        )

    def extract(self, file_path: str) -> DataFrame:
        return read_csv(self.spark, file_path, **self.kwargs)

    def extract_with_validation(
        self, file_path: str, expected_columns: Sequence[str] | None = None, min_rows: int = 1
    ) -> DataFrame:
        return read_csv_validated(self.spark, file_path, expected_columns, min_rows, **self.kwargs)


class ParquetExtractor:
    def __init__(
        self,
        spark: SparkSession,
        schema: T.StructType | None = None,
        options: Mapping[str, Any] | None = None,
    ):
        self.spark = spark
        self.kwargs = dict(schema=schema, options=dict(options or {}))

    def extract(self, file_path: str) -> DataFrame:
        return read_parquet(self.spark, file_path, **self.kwargs)

    def extract_with_validation(
        self, file_path: str, expected_columns: Sequence[str] | None = None, min_rows: int = 1
    ) -> DataFrame:
        return read_parquet_validated(
            self.spark, file_path, expected_columns, min_rows, **self.kwargs
        )


class BaseProcessor:
    def __init__(self, schema: T.StructType | None = None):
        self.schema = schema

    def apply_schema(self, df: DataFrame) -> DataFrame:
        return conform(df, self.schema)

    def trim_string_columns(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        return trim_strings(df, columns)

    def handle_missing_values(
        self,
        df: DataFrame,
        string_columns: Sequence[str] | None = None,
        numeric_columns: Sequence[str] | None = None,
        default_string: str = "Unknown",
        default_numeric: float | int = 0.0,
    ) -> DataFrame:
        return fill_missing(df, string_columns, numeric_columns, default_string, default_numeric)

    def remove_duplicates(self, df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
        return dedup(df, subset)


class CustomerProcessor(BaseProcessor):
    def __init__(self, columns: schemas.Entity | None = None):
        self.columns = columns or CustomerColumns()
        super().__init__(self.columns.schema())

    def process(self, df: DataFrame) -> DataFrame:
        return customer_pipeline(df, self.columns)

    def validate_age(self, df: DataFrame) -> DataFrame:
        return cust.validate_age(df, self.columns.age)

    def validate_and_clean_gender(self, df: DataFrame, gender_column: str = "gender") -> DataFrame:
        return cust.clean_gender(df, gender_column)

    def clean_customer_names(self, df: DataFrame, name_columns: Sequence[str]) -> DataFrame:
        return cust.clean_names(df, name_columns)

    def validate_customer_data(self, df: DataFrame) -> DataFrame:
        return cust.validate_customers(df, self.columns.customer_id)


class SalesProcessor(BaseProcessor):
    def __init__(self, columns: schemas.Entity | None = None, date_mode: str = "parse_first"):
        self.columns = columns or SalesColumns()
        self.date_mode = date_mode
        super().__init__(self.columns.schema())

    def process(self, df: DataFrame) -> DataFrame:
        return sales_pipeline(df, self.columns, self.date_mode)

    def process_invoice_date(self, df: DataFrame) -> DataFrame:
        return sal.parse_invoice_date(df, self.columns.invoice_date)

    def validate_numeric_fields(self, df: DataFrame) -> DataFrame:
        return sal.validate_numeric_fields(df, self.columns)

    def clean_category(self, df: DataFrame) -> DataFrame:
        return sal.clean_category(df, self.columns.category)

    def clean_shopping_mall_names(self, df: DataFrame) -> DataFrame:
        return sal.clean_mall_names(df, self.columns.shopping_mall)

    def validate_sales_data(self, df: DataFrame) -> DataFrame:
        return sal.validate_sales(df, self.columns)


class DeltaLoader:
    """Path / table sink; ``fmt`` defaults to Parquet (Delta where installed)."""

    def __init__(
        self,
        spark: SparkSession,
        mode: str = "overwrite",
        options: Mapping[str, Any] | None = None,
        fmt: str = "parquet",
    ):
        self.spark = spark
        self.mode = mode
        self.options = dict(options or {})
        self.fmt = fmt

    def load(self, df: DataFrame, destination: str) -> None:
        write_path(df, destination, fmt=self.fmt, mode=self.mode, options=self.options)

    def load_as_table(self, df: DataFrame, table_name: str, database: str | None = None) -> None:
        write_table(df, table_name, database, fmt=self.fmt, mode=self.mode, options=self.options)
