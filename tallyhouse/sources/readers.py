"""Readers for the formats the jobs take."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import LOCAL_ZONE, in_months, parse_day, sheet_month, to_local
from ..operators.joins import newest_by_key
from . import files
from .schemas import HEADER_TEXT, INSTALMENT_TEXT, PURCHASE_DOCUMENT, PURCHASE_TEXT, snake


def read_table(spark: SparkSession, name: str, columns: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """A catalog table, only the columns and rows asked for."""
    df = spark.table(name)
    df = df.filter(where) if where is not None else df
    return df.select(*columns) if columns else df


def read_query(spark: SparkSession, url: str, query: str, split: str | None = None, bounds: tuple[int, int] = (0, 0), parts: int = 1, **options: str) -> DataFrame:
    """A SQL query on a database endpoint; `split` reads it in ranges of a number column."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if not split:
        return reader.option("query", query).load()
    ranges = {"partitionColumn": split, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": parts}
    return reader.option("dbtable", f"({query}) q").options(**{k: str(v) for k, v in ranges.items()}).load()


def bare_names(df: DataFrame) -> DataFrame:
    """Column names 'Table[Column]' or '[Column]' cut to 'Column'."""
    return df.toDF(*[c[c.index("[") + 1 : -1] if c.endswith("]") and "[" in c else c for c in df.columns])


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns by alias: {alias: column}."""
    return df.select(*[F.col(f"`{c}`").alias(a) for a, c in columns.items()])


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, limit: int | None = None,
    multi_line: bool = False, sep: str = ",",
) -> DataFrame:
    """CSV with a header; quoted fields, doubled quotes, trimmed values.

    Without a schema all columns are text, and missing values are ''.
    """
    options = {
        "header": True, "quote": '"', "escape": '"', "sep": sep, "multiLine": multi_line,
        "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True, "encoding": "UTF-8",
    }
    df = spark.read.options(**options).schema(schema).csv(path) if schema else spark.read.options(**options).csv(path)
    df = df if schema else df.fillna("")
    return df.limit(limit) if limit else df


def read_purchases(spark: SparkSession, path: str | list[str], arrays: bool = False) -> DataFrame:
    """Purchase documents, one JSON object per line; with `arrays` one array per file, which makes a file one task."""
    return spark.read.schema(PURCHASE_DOCUMENT).json(path, multiLine=arrays)


def flatten_purchases(documents: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Purchase level: header and purchase fields, instants in local time, lists as JSON text."""

    def local(c: Column) -> Column:
        return to_local(F.try_to_timestamp(c), zone)

    p = F.col("purchase")
    instants = {"created", "apiCreated", "apiUpdated"}
    header = [F.col(n).alias(snake(n)) for n in HEADER_TEXT if n != "orderDate"]
    body = [p[n].alias("purchase_status" if n == "status" else snake(n)) for n in PURCHASE_TEXT if n not in instants]
    created = local(p["created"])
    return documents.select(
        *header, *body, "orderNumber", F.coalesce("anticipation", F.lit(False)).alias("anticipation"),
        parse_day(F.col("orderDate")).alias("order_date"),
        F.coalesce(p["amount"], F.lit(0)).alias("amount_cents"),
        F.coalesce(p["fee"], F.lit(0)).alias("fee_cents"),
        F.coalesce(p["installmentCount"], F.lit(0)).alias("installment_count"),
        F.to_json(F.coalesce(p["tags"], F.array().cast("array<string>"))).alias("tags"),
        F.to_json(F.coalesce(p["transactionIds"], F.array().cast("array<string>"))).alias("transaction_ids"),
        F.to_json(F.coalesce(p["metadata"], F.create_map().cast("map<string,string>"))).alias("metadata_json"),
        created.alias("created"),
        F.coalesce(local(p["apiCreated"]), created).alias("api_created"),
        local(p["apiUpdated"]).alias("api_updated"),
    ).withColumnRenamed("orderNumber", "order_number")


def flatten_instalments(documents: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Instalment level, numbered by due date inside each purchase."""
    due_first = F.array_sort(
        F.coalesce("purchase.installments", F.array()),
        lambda a, b: F.when(F.coalesce(a["due"], F.lit("")) < F.coalesce(b["due"], F.lit("")), -1)
        .when(F.coalesce(a["due"], F.lit("")) > F.coalesce(b["due"], F.lit("")), 1).otherwise(0),
    )
    rows = documents.select(F.col("purchase.purchaseId").alias("purchase_id"), F.posexplode(due_first).alias("pos", "i"))
    instants = {"due", "nominalDue", "apiCreated", "apiUpdated"}
    texts = [
        (to_local(F.try_to_timestamp(F.col("i")[n]), zone) if n in instants else F.col("i")[n]).alias(
            "installment_id" if n == "id" else snake(n)
        )
        for n in INSTALMENT_TEXT
    ]
    return rows.select(
        "purchase_id", (F.col("pos") + 1).alias("installment_number"), *texts,
        F.coalesce("i.amount", F.lit(0)).alias("amount_cents"), F.coalesce("i.fee", F.lit(0)).alias("fee_cents"),
        F.coalesce("i.isProtected", F.lit(False)).alias("is_protected"),
        F.to_json("i.tags").alias("tags"), F.to_json("i.transactionIds").alias("transaction_ids"),
    )


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in a folder, on whatever store it lies."""
    return [n for n in files.names(spark, root, only_folders=True) if n[0] not in "._"]


def latest_sheet(lines: DataFrame, sheet: str = "sheet") -> DataFrame:
    """Lines of the sheet with the latest month in its name."""
    dated = lines.withColumn("_month", sheet_month(F.col(sheet)))
    newest = dated.agg(F.max("_month")).scalar()
    return dated.filter(F.col("_month") == newest).drop("_month")


def with_fallback(main: DataFrame, poorer: DataFrame, key: str) -> DataFrame:
    """Main source by key; keys it lacks come from the poorer source."""
    return newest_by_key([main, poorer], key)


def years_of(df: DataFrame, ts: str, years: Sequence[int]) -> DataFrame:
    """One scan for several years instead of one per year."""
    spans = [in_months(ts, dt.date(y, 1, 1), dt.date(y + 1, 1, 1)) for y in years]
    return df.filter(reduce(or_, spans, F.lit(False)))


def read_if_exists(spark: SparkSession, name: str) -> DataFrame | None:
    """A table that exists and has rows, else nothing."""
    if not spark.catalog.tableExists(name):
        return None
    df = spark.table(name)
    return None if df.isEmpty() else df
