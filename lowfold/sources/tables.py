"""Tables in, embeddings out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lowfold.operators.layout import flat_embedding
from lowfold.operators.prepare import check_input, numeric_select


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV table with a header; give a schema to save the pass that infers one.

    The header has to name the columns of the schema in their order, and a value
    that does not fit its type is an error when it is read.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).option("mode", "FAILFAST").schema(schema).csv(path)


def read_features(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, max_rows: int | None = None
) -> DataFrame:
    """The numeric columns of a CSV table that passes the input check."""
    df = numeric_select(read_csv(spark, path, schema))
    check_input(df, max_rows=max_rows)
    return df


def read_with_target(
    spark: SparkSession, path: str, target: str | None, schema: T.StructType | str | None = None
) -> tuple[DataFrame, str | None]:
    """All columns of a CSV table, and which of them is the target."""
    df = read_csv(spark, path, schema)
    if target is not None and target not in df.columns:
        raise ValueError(f"there is no column {target!r}")
    return df, target


def embedding_with_clusters(embedding: DataFrame, clusters: DataFrame, components: int) -> DataFrame:
    """``(id, dim_0, ..., cluster)``."""
    return flat_embedding(embedding, components).join(clusters.select("id", "cluster"), "id")


def result_summary(embedding: DataFrame, n_features: int) -> DataFrame:
    """One row: number of rows and features, and the shape of the embedding."""
    width = F.max(F.size("y"))
    return embedding.agg(F.count("*").alias("n_samples"), F.lit(n_features).alias("n_features"), width.alias("n_components"))


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "error") -> None:
    """Write a flat result; CSV files carry a header."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
