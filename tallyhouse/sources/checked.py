"""Readers that hand bad input to a second output instead of turning it into nulls.

A checked frame has the reader's columns and a struct `_bad` (file, record, reason), null in good
rows. `split_bad` gives both outputs as frames, `quarantined` writes the frame once and
reads both from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import files
from .schemas import PURCHASE_DOCUMENT

RAW = "_corrupt_record"
BAD = "struct<file: string, record: string, reason: string>"


def _marked(rows: DataFrame, columns: list[Column], record: Column, reasons: list[Column]) -> DataFrame:
    """Rows with `_bad` where a reason is given; reasons are texts or null."""
    reason = F.concat_ws("; ", *reasons)
    bad = F.struct(F.col("_metadata.file_path").alias("file"), record.alias("record"), reason.alias("reason"))
    return rows.select(*columns, F.when(reason != "", bad).cast(BAD).alias("_bad"))


def split_bad(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad ones as (file, record, reason)."""
    return checked.where("_bad is null").drop("_bad"), checked.where("_bad is not null").select("_bad.*")


def quarantined(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The same outputs from a folder that is written in one run, good and bad rows apart."""
    checked.withColumn("_is_bad", F.col("_bad").isNotNull()).write.partitionBy("_is_bad").parquet(path)
    schema = T.StructType([*checked.schema.fields, T.StructField("_is_bad", T.BooleanType())])
    rows = checked.sparkSession.read.schema(schema).parquet(path)
    good, bad = rows.where("not _is_bad"), rows.where("_is_bad")
    return good.drop("_bad", "_is_bad"), bad.select("_bad.*")


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, multi_line: bool = False, sep: str = ",") -> DataFrame:
    """Typed CSV with a header, as `readers.read_csv` reads it.

    Bad are lines with a value that its column cannot hold, and lines with more fields
    than columns. Missing fields at the end of a line are null, as blank ones are.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names, n = [f.name for f in schema.fields], len(schema.fields)
    options = {"quote": '"', "escape": '"', "sep": sep, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    # With column pruning the parser would not see how many fields a line has.
    read = spark.read.options(**options, header=True, multiLine=multi_line, encoding="UTF-8", columnNameOfCorruptRecord=RAW, columnPruning=False)
    rows = read.schema(T.StructType([T.StructField(c, T.StringType()) for c in (*names, RAW)])).csv(path)
    # Lines that the parser complains of have fewer or more fields; they are cut again with one field more.
    cut = F.from_csv(F.col(RAW), ", ".join(f"_{i} string" for i in range(n + 1)), options)
    rows = rows.withColumn("_more", F.when(F.col(RAW).isNotNull(), cut[f"_{n}"]))

    def value(f: T.StructField) -> Column:
        text = F.col(f"`{f.name}`")
        return text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)

    reasons = [
        F.when(F.col(f"`{f.name}`").isNotNull() & value(f).isNull(), F.concat(F.lit(f"{f.name}: "), F.col(f"`{f.name}`"), F.lit(f" is no {f.dataType.simpleString()}")))
        for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    reasons.append(F.when(F.col("_more").isNotNull(), F.lit(f"more than {n} fields")))
    record = F.coalesce(F.col(RAW), F.to_csv(F.struct(*[f"`{c}`" for c in names]), {"sep": sep, "escape": '"'}))
    return _marked(rows, [value(f).alias(f.name) for f in schema.fields], record, reasons)


def _as_text(kind: T.DataType) -> T.DataType:
    """The type with every number and truth value as text, so that the parser keeps what it finds."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return kind if isinstance(kind, (T.StringType, T.MapType)) else T.StringType()


def _value(text: Column, kind: T.DataType) -> Column:
    """A text as a number, cut to a whole one, or as a truth value; null if it is neither."""
    name = kind.simpleString()
    if isinstance(kind, T.IntegralType):
        return F.coalesce(text.try_cast(name), text.try_cast("decimal(38,6)").try_cast(name))
    return text.try_cast(name)


def _typed(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_typed(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _typed(x, kind.elementType))
    return c if isinstance(kind, (T.StringType, T.MapType)) else _value(c, kind)


def _wrong(text: Column, kind: T.DataType) -> Column:
    return text.isNotNull() & _value(text, kind).isNull()


def _is_leaf(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StringType, T.StructType, T.ArrayType, T.MapType))


def _wrong_in(items: Column, field: T.StructField) -> Column:
    """Texts of a field of an array's structs that are no value of its type."""
    texts = F.transform(items, lambda x: x[field.name])
    return F.filter(texts, lambda t: _wrong(t, field.dataType))


def _leaves(c: Column, kind: T.DataType, path: str) -> Iterator[tuple[str, Column]]:
    """For each number and truth value of a document: its path, and the texts in it that are none (an array)."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _leaves(c[f.name], f.dataType, f"{path}.{f.name}")
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        for f in filter(lambda f: _is_leaf(f.dataType), kind.elementType.fields):
            yield f"{path}.{f.name}", _wrong_in(c, f)
    elif _is_leaf(kind):
        yield path, F.when(_wrong(c, kind), F.array(c))


def read_documents(spark: SparkSession, path: str | list[str], schema: T.StructType, need: tuple[str, ...] = (), arrays: bool = False) -> DataFrame:
    """JSON documents, one to a line (with `arrays` one array per file), typed by a schema.

    Bad are lines that are no JSON, documents of another structure, numbers and truth values that
    are none, and documents without a field of `need`. A number may stand as text.
    """
    read = spark.read.options(multiLine=arrays, columnNameOfCorruptRecord=RAW)
    rows = read.schema(T.StructType([*_as_text(schema).fields, T.StructField(RAW, T.StringType())])).json(path)
    broken = F.when(F.col(RAW).isNotNull(), F.when(F.try_parse_json(RAW).isNull(), F.lit("no JSON")).otherwise(F.lit("another structure")))
    wrong = [F.when(F.size(found) > 0, F.concat(F.lit(f"{name}: "), F.array_join(found, ", "), F.lit(" is no value"))) for f in schema.fields for name, found in _leaves(F.col(f"`{f.name}`"), f.dataType, f.name)]
    absent = [F.when(F.col(RAW).isNull() & F.col(name).isNull(), F.lit(f"without {name}")) for name in need]
    whole = F.coalesce(F.col(RAW), F.to_json(F.struct(*[f"`{f.name}`" for f in schema.fields])))
    return _marked(rows, [_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields], whole, [broken, *wrong, *absent])


def read_purchases(spark: SparkSession, path: str | list[str], arrays: bool = False) -> DataFrame:
    """Purchase documents; one without the id that later steps keep it by is bad."""
    return read_documents(spark, path, PURCHASE_DOCUMENT, ("purchase.purchaseId",), arrays)


SMALL = 256 << 10  # bytes; a file without rows is a footer only, far below this


def _rowless(content: Column) -> Column:
    """Whether a Parquet file is its two marks and a footer, with no pages: mark, footer, its length in four bytes, mark."""
    length = F.conv(F.concat(*[F.hex(F.substring(content, -5 - i, 1)) for i in range(4)]), 16, 10).cast("long")
    marks = (F.substring(content, 1, 4) == F.lit(b"PAR1")) & (F.substring(content, -4, 4) == F.lit(b"PAR1"))
    return marks & (length + 12 == F.octet_length(content))


def dataset_report(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Every file of every folder of `root`: rows by its footer (`named`) and rows that could be decoded, in one job.

    A damaged file ends where it cannot be read on, so it decodes fewer rows than its footer names;
    page checksums are compared where the writer left them. A file without a readable footer has neither number.
    """
    quiet = {"ignoreCorruptFiles": "true", "parquet.page.verify-checksum.enabled": "true"}
    at = F.col("_metadata.file_path").alias("path")
    none = F.lit(None).cast("long")
    listed = spark.read.format("binaryFile").load(f"{root}/*")
    large = listed.where(F.col("length") > SMALL).select(at, none.alias("named"), none.alias("decoded"))
    # A file without rows is in no group below; its few bytes tell it from one whose footer is gone.
    little = listed.where(F.col("length") <= SMALL).select(at, F.when(_rowless(F.col("content")), F.lit(0).cast("long")).alias("named"), none.alias("decoded"))
    footers = spark.read.options(**quiet).schema(T.StructType([])).parquet(f"{root}/*").groupBy(at).agg(F.count("*").alias("named"), F.max(none).alias("decoded"))
    hashable = [F.map_entries(f.name) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in schema.fields]
    # Always true, but only once every column is decoded; a plain count would read footers only.
    whole = F.pmod(F.xxhash64(*hashable), F.lit(2)) >= 0
    decoded = spark.read.options(**quiet).schema(schema).parquet(f"{root}/*").groupBy(at).agg(F.max(none).alias("named"), F.count_if(whole).alias("decoded"))
    both = large.unionByName(little).unionByName(footers).unionByName(decoded)
    return both.groupBy("path").agg(F.max("named").alias("named"), F.max("decoded").alias("decoded"))


def read_datasets(spark: SparkSession, root: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """The same table out of one folder per brand, and a report on the folders.

    A dataset is read whole or not at all: one with a file that cannot be decoded to its end is
    skipped. The report has brand, rows and, for skipped ones, the error with the first damaged file. The
    folder name becomes column `brand`. All files are decoded by one job first, however many folders there are.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = files.names(spark, root, only_folders=True)
    brands = [n for n in names if n[0] not in "._"]
    folder = F.url_decode(F.element_at(F.split("path", "/"), -2))
    file = F.element_at(F.split("path", "/"), -1)
    error = F.when(F.col("named").isNull(), F.concat(file, F.lit(": no readable footer"))).when(
        F.coalesce("decoded", F.lit(0)) < F.col("named"), F.concat(file, F.lit(": "), F.coalesce("decoded", F.lit(0)), F.lit(" of "), F.col("named"), F.lit(" rows could be decoded"))
    )
    per = dataset_report(spark, root, schema).groupBy(folder.alias("brand")).agg(F.coalesce(F.sum("decoded"), F.lit(0)).alias("rows"), F.min(error).alias("error")) if brands else None
    found = {r.brand: (r.rows, r.error) for r in per.collect()} if per else {}  # a row for each folder
    report, kept = [], []
    for name in brands:
        brand = unquote(name)
        rows, wrong = found.get(brand, (0, None))
        report.append((brand, None if wrong else rows or 0, wrong))
        if not wrong and brand in found:
            kept.append(f"{root}/{name}")
    here = F.element_at(F.split("_metadata.file_path", "/"), -2)
    empty = spark.createDataFrame([], schema).withColumn("brand", F.lit(""))
    df = spark.read.schema(schema).parquet(*kept).select("*", F.url_decode(here).alias("brand")) if kept else empty
    return df, spark.createDataFrame(report, "brand string, rows long, error string")
