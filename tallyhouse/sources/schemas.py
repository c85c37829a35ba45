"""Explicit input schemas and the step that maps alias headers to one name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

# Field names of the purchase documents.
PURCHASE_TEXT = [
    "purchaseId", "status", "currencyCode", "fundingType", "network", "cardId", "cardEnding", "holderId", "holderName",
    "holderEmail", "holderPhone", "billingCity", "billingStateCode", "billingCountryCode", "billingZipCode",
    "billingStreetLine1", "billingStreetLine2", "challengeMode", "challengeUrl", "endToEndId", "softDescriptor", "source",
    "created", "apiCreated", "apiUpdated",
]
INSTALMENT_TEXT = ["id", "due", "nominalDue", "status", "fundingType", "network", "apiCreated", "apiUpdated"]
HEADER_TEXT = ["workspaceId", "transactionId", "orderId", "companyId", "brand", "customerName", "orderDate"]

_text, _long = T.StringType(), T.LongType()
_texts = T.ArrayType(T.StringType())

INSTALMENT = T.StructType(
    [T.StructField(n, _text) for n in INSTALMENT_TEXT]
    + [T.StructField("amount", _long), T.StructField("fee", _long), T.StructField("isProtected", T.BooleanType())]
    + [T.StructField("tags", _texts), T.StructField("transactionIds", _texts)]
)
PURCHASE = T.StructType(
    [T.StructField(n, _text) for n in PURCHASE_TEXT]
    + [T.StructField("amount", _long), T.StructField("fee", _long), T.StructField("installmentCount", T.IntegerType())]
    + [T.StructField("tags", _texts), T.StructField("transactionIds", _texts)]
    + [T.StructField("metadata", T.MapType(T.StringType(), T.StringType())), T.StructField("installments", T.ArrayType(INSTALMENT))]
)
PURCHASE_DOCUMENT = T.StructType(
    [T.StructField(n, _text) for n in HEADER_TEXT]
    + [T.StructField("orderNumber", _long), T.StructField("anticipation", T.BooleanType()), T.StructField("purchase", PURCHASE)]
)

ORDERS = (
    "order_id string, order_number bigint, domain_id string, company_id string, created_at timestamp, total decimal(18,2), "
    "payment_method string, payment_status string, order_status string, is_paid boolean, paid_at timestamp, is_canceled boolean, is_closed boolean, "
    "transaction_value decimal(18,2), provider string, customer_name string, customer_doc string, source string"
)
PLAN_LINES = (
    "tax_id string, brand string, plan string, setup decimal(18,2), monthly decimal(18,2), integration decimal(18,2), "
    "assistant decimal(18,2), branch decimal(18,2), discount decimal(18,2), total decimal(18,2), notes string, sub_account string"
)


def snake(name: str) -> str:
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()


def harmonise(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """One column per target name: the first alias with a value, null if none exists."""
    out = []
    for target, names in aliases.items():
        present = [F.nullif(F.trim(F.col(f"`{n}`").cast("string")), F.lit("")) for n in names if n in df.columns]
        out.append((F.coalesce(*present) if present else F.lit(None).cast("string")).alias(target))
    return df.select(*out)


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Only the schema's columns, cast; missing ones are null."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
