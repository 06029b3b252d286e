"""Silver schemas and column roles, declared once for each entity.

Column names are configurable per entity; every rule refers to the
configured name and the output keeps it.
"""

from __future__ import annotations

from dataclasses import make_dataclass

from pyspark.sql import types as T

KEY, TEXT, NUMBER, FILLED, REQUIRED = "key", "text", "number", "filled", "required"


class Entity:
    """An entity's columns: one attribute per declared field, holding the
    column's name; schema and roles follow from the declaration."""

    FIELDS: tuple[tuple[str, T.DataType, frozenset[str]], ...] = ()

    def having(self, role: str) -> list[str]:
        return [getattr(self, field) for field, _, roles in self.FIELDS if role in roles]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(getattr(self, field), kind) for field, kind, _ in self.FIELDS])


def _entity(name: str, *declared: tuple) -> type:
    fields = tuple((field, kind, frozenset(roles)) for field, kind, *roles in declared)
    return make_dataclass(
        name, [(field, str, field) for field, _, _ in fields], bases=(Entity,),
        namespace={"FIELDS": fields}, frozen=True, module=__name__,
    )


# Field names, types and their order.
CustomerColumns = _entity(
    "CustomerColumns",
    ("customer_id", T.StringType(), KEY, TEXT),
    ("gender", T.StringType(), TEXT, FILLED),
    ("age", T.IntegerType(), NUMBER),
    ("payment_method", T.StringType(), TEXT, FILLED),
)
SalesColumns = _entity(
    "SalesColumns",
    ("invoice_no", T.StringType(), KEY, TEXT, REQUIRED),
    ("customer_id", T.StringType(), TEXT, REQUIRED),
    ("category", T.StringType(), TEXT, FILLED),
    ("quantity", T.IntegerType(), NUMBER, REQUIRED),
    ("price", T.DoubleType(), NUMBER, REQUIRED),
    ("invoice_date", T.DateType()),
    ("shopping_mall", T.StringType(), TEXT, FILLED),
)


def customer_schema(columns: Entity | None = None) -> T.StructType:
    return (columns or CustomerColumns()).schema()


def sales_schema(columns: Entity | None = None) -> T.StructType:
    return (columns or SalesColumns()).schema()
