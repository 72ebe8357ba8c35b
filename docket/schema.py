"""Column roles and the saved schema: roles go by name, never by position."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docket import constants as C


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in a case table."""

    key: str = C.KEY
    target: str = C.TARGET
    job: str = C.JOB_TITLE
    helpers: tuple[str, ...] = ("label", "fold", "copies", "weight")

    def features(self, df: DataFrame) -> list[str]:
        """Every column but the key, the target and columns the jobs add, in table order."""
        return [c for c in df.columns if c not in (self.key, self.target, *self.helpers)]

    def numeric(self, df: DataFrame) -> list[str]:
        """Features with a numeric type."""
        return [c for c in self.features(df) if isinstance(df.schema[c].dataType, T.NumericType)]

    def categorical(self, df: DataFrame) -> list[str]:
        """Features with a string or boolean type."""
        kinds = (T.StringType, T.BooleanType)
        return [c for c in self.features(df) if isinstance(df.schema[c].dataType, kinds)]

    def evidence(self, df: DataFrame) -> list[str]:
        """Features whose name marks them as evidence flags."""
        return columns_like(self.features(df), contains=C.EVIDENCE_PATTERN)


def columns_like(columns: list[str], contains: str | None = None, without: str | None = None) -> list[str]:
    """Choose column names by a substring they hold and one they lack."""
    return [
        c
        for c in columns
        if (contains is None or contains in c) and (without is None or without not in c)
    ]


def conform_types(df: DataFrame) -> DataFrame:
    """Spell booleans as text and turn NaN into null, so one rule covers missing values."""
    out = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            col = F.when(col, C.TRUE_TEXT).when(~col, C.FALSE_TEXT)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(field.name))
    return df.select(*out)


def conform_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the saved columns in the saved order and types; an absent column is an error."""
    absent = [name for name in schema.names if name not in df.columns]
    if absent:
        raise ValueError(f"columns absent from the table: {', '.join(absent)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Store a schema as JSON text beside the data it describes."""
    row = spark.createDataFrame([(schema.json(),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """Read a schema stored by :func:`save_schema`."""
    import json

    return T.StructType.fromJson(json.loads(spark.read.text(path).first()[0]))
