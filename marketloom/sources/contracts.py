"""Declared tables: fields, keys, references."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KINDS = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    """A column: its kind, whether it may be missing, and its allowed values."""

    name: str
    kind: str
    nullable: bool = False
    allowed: tuple = ()


@dataclass(frozen=True)
class Contract:
    """A table: fields, primary key, and (columns, parent, parent columns) references."""

    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...] = ()
    references: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def raw_schema(self) -> T.StructType:
        """All columns as strings, as files are read before casting."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, KINDS[f.kind], f.nullable) for f in self.fields])

    def require_columns(self, present: list[str]) -> None:
        missing = [c for c in self.columns if c not in present]
        if missing:
            raise ValueError(f"{self.name}: missing columns {missing}")


_FLAG = (0, 1)
# The measure columns of a purchase line.
_MEASURES = ("regular_points_received", "express_points_received", "regular_points_spent", "express_points_spent", "purchase_sum")

REGISTRY: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract(
            "clients",
            (
                Field("client_id", "string"),
                Field("first_issue_date", "timestamp"),
                Field("first_redeem_date", "timestamp", nullable=True),
                Field("age", "double", nullable=True),
                Field("gender", "string", nullable=True),
            ),
            ("client_id",),
        ),
        Contract(
            "products",
            (
                Field("product_id", "string"),
                *(Field(f"level_{k}", "string", nullable=True) for k in range(1, 5)),
                Field("segment_id", "double", nullable=True),
                Field("brand_id", "string", nullable=True),
                Field("vendor_id", "string", nullable=True),
                Field("netto", "double", nullable=True),
                Field("is_own_trademark", "integer", allowed=_FLAG),
                Field("is_alcohol", "integer", allowed=_FLAG),
            ),
            ("product_id",),
        ),
        Contract(
            "purchases",
            (
                Field("client_id", "string"),
                Field("transaction_id", "string"),
                Field("transaction_datetime", "timestamp"),
                *(Field(m, "double") for m in _MEASURES),
                Field("store_id", "string"),
                Field("product_id", "string"),
                Field("product_quantity", "double"),
                Field("trn_sum_from_iss", "double", nullable=True),
                Field("trn_sum_from_red", "double", nullable=True),
            ),
            (),
            ((("client_id",), "clients", ("client_id",)), (("product_id",), "products", ("product_id",))),
        ),
        Contract(
            "uplift_train",
            (
                Field("client_id", "string"),
                Field("treatment_flg", "integer", allowed=_FLAG),
                Field("target", "integer", allowed=_FLAG),
            ),
            ("client_id",),
            ((("client_id",), "clients", ("client_id",)),),
        ),
        Contract("uplift_test", (Field("client_id", "string"),), ("client_id",), ((("client_id",), "clients", ("client_id",)),)),
    )
}
