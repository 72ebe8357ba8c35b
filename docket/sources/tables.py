"""Read and write case tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docket.schema import conform_columns, conform_types, load_schema, save_schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_raw(spark: SparkSession, path: str, schema: T.StructType | None = None, schema_path: str | None = None) -> DataFrame:
    """Scan a CSV file with a header.

    With a schema the file is read once. Without one, types are inferred on first
    contact and saved under ``schema_path``, so later reads skip that pass.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.option("inferSchema", True).csv(path)
    if schema_path:
        save_schema(spark, df.schema, schema_path)
    return df


def write_prepared(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Replace the prepared table and the schema stored with it."""
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)
    save_schema(df.sparkSession, df.schema, f"{path.rstrip('/')}.schema")


def read_prepared(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """Scan a prepared table with its stored schema."""
    schema = load_schema(spark, f"{path.rstrip('/')}.schema")
    reader = spark.read.schema(schema)
    if form == "csv":
        reader = reader.option("header", True)
    return reader.format(form).load(path)


def read_future(
    spark: SparkSession, path: str, schema: T.StructType, form: str = "csv", raw_schema: T.StructType | None = None
) -> DataFrame:
    """Scan future cases and conform them to the training columns.

    ``schema`` has the columns as training saw them, ``raw_schema`` as the raw table types them. A CSV
    file is read with the raw types, so a boolean spelled ``true`` in it becomes the training's ``True``;
    columns are found by the header's names, whatever their order.
    """
    reader = spark.read
    if form == "csv":
        reader = reader.option("header", True)
        if raw_schema is not None:
            text = reader.csv(path)
            known = {f.name: f.dataType for f in raw_schema.fields}
            typed = text.select(*[F.col(c).cast(known.get(c, T.StringType())).alias(c) for c in text.columns])
            return conform_columns(conform_types(typed), schema)
    return conform_columns(conform_types(reader.format(form).load(path)), schema)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV output with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_scores(predictions: DataFrame, evidence: DataFrame, folder: str) -> None:
    """Replace the two outputs of the scoring job."""
    write_csv(predictions, f"{folder.rstrip('/')}/predictions")
    write_csv(evidence, f"{folder.rstrip('/')}/evidences")


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(key).limit(rows)
