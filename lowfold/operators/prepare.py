"""Column selection, checks, identity, sampling and standardisation of input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lowfold.session import StepStore

WIDE = 128
LARGEST = 1e150


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns in table order; booleans, text and dates are not."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def numeric_select(df: DataFrame, target: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns without the target; ``keep`` columns (keys) stay as they are."""
    names = numeric_columns(df, exclude=[*(keep or ()), *([target] if target else [])])
    return df.select(*keep, *names)


def check_input(
    df: DataFrame, min_features: int = 3, max_rows: int | None = None, exclude: Sequence[str] = ()
) -> list[str]:
    """Names of the feature columns, or an error when the table is unfit.

    Without ``max_rows`` only the schema is looked at; with it no more than
    ``max_rows`` rows are counted.
    """
    names = numeric_columns(df, exclude)
    if len(names) < min_features:
        raise ValueError(f"at least {min_features} numeric columns are needed, found {len(names)}")
    if max_rows is not None and df.select().limit(max_rows).count() >= max_rows:
        raise ValueError(f"the table must have fewer than {max_rows} rows")
    return names


def match_features(df: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
    """New rows in the column order of a saved model."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the new rows: {missing}")
    return df.select(id_col, *features)


def bounded_sample(df: DataFrame, id_col: str, n: int = 499, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run and partitioning."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("sample"), F.col(id_col).cast("string")))
    # Far more than n rows are expected below the bound, so that no partition sends n rows of its own.
    total = df.select(id_col).count()
    share = min(1.0, (4.0 * n + 64) / max(1, total))
    bound = f"{min((1 << 32) - 1, int(share * (1 << 32))):08x}"
    near = df.filter(F.substring(key, 1, 8) <= bound)
    few = share < 1.0 and near.select(id_col).limit(n).count() < n
    return (df if few else near).orderBy(key, id_col).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def profile(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """One row with ``n_samples`` and ``n_features``."""
    width = len(features) if features is not None else len(numeric_columns(df))
    return df.agg(F.count("*").alias("n_samples"), F.lit(width).alias("n_features"))


def experiment_label(base: str, source: Column | str | None = None, env: str = "dev") -> Column:
    """``/{source or env}/{base}`` as a column."""
    source = F.lit(source) if source is None or isinstance(source, str) else source
    source = F.when(source != "", source)
    return F.concat(F.lit("/"), F.coalesce(source, F.lit(env)), F.lit("/" + base))


def dense_index(df: DataFrame, id_col: str, steps: StepStore) -> DataFrame:
    """Add ``idx``, the rank 0..N-1 of the row's key; null and repeated keys are refused.

    Rows are range-partitioned by the key and written once; only the row count
    of each partition reaches the driver.
    """
    unique_keys(df, id_col)
    bounds = df.agg(F.min(id_col), F.max(id_col), F.count(id_col)).first()
    if isinstance(df.schema[id_col].dataType, T.IntegralType) and bounds[0] == 0 and bounds[1] == bounds[2] - 1:
        return df.withColumn("idx", F.col(id_col).cast("bigint"))
    ordered = df.repartitionByRange(F.col(id_col)).sortWithinPartitions(id_col)
    return row_numbers(ordered, steps, "idx")


def unique_keys(df: DataFrame, id_col: str) -> None:
    """Raise where a key is null or comes twice; only the keys are shuffled."""
    wrong = df.groupBy(id_col).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col(id_col).isNull())
    found = wrong.limit(1).collect()
    if found:
        raise ValueError(f"keys should be unique and not null; {id_col} = {found[0][0]!r} comes {found[0][1]} times")


def row_numbers(df: DataFrame, steps: StepStore, name: str = "id") -> DataFrame:
    """Number rows 0..N-1 by partition and place in it, for tables without a key.

    The rows are written once with their place, so the numbers stay put; only
    the row count of each partition reaches the driver.
    """
    place = F.monotonically_increasing_id()
    part, at = F.shiftright(place, 33), place.bitwiseAND((1 << 33) - 1)
    written = steps.save(df.withColumn("_part", part).withColumn("_at", at), "numbered")
    offsets, total = [], 0
    for r in written.groupBy("_part").count().orderBy("_part").collect():
        offsets.append((r["_part"], total))
        total += r["count"]
    table = df.sparkSession.createDataFrame(offsets, "_part BIGINT, _offset BIGINT")
    joined = written.join(F.broadcast(table), "_part")
    return joined.withColumn(name, F.col("_offset") + F.col("_at")).drop("_part", "_at", "_offset")


def assemble(df: DataFrame, id_col: str, features: Sequence[str] | str) -> DataFrame:
    """``points(id, features ARRAY<DOUBLE>)`` from number columns or one array column."""
    if isinstance(features, str):
        vector = F.col(features).cast("array<double>")
    else:
        vector = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    return df.select(F.col(id_col).alias("id"), vector.alias("features"))


def clean_points(points: DataFrame, na_policy: str = "raise") -> DataFrame:
    """Refuse, or on ``na_policy='drop'`` leave out, rows with null, NaN or infinite values,
    or with values so large that their squares are."""
    bad = F.exists("features", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > LARGEST))
    bad = F.col("id").isNull() | F.col("features").isNull() | bad
    if na_policy == "drop":
        return points.filter(~bad)
    if na_policy != "raise":
        raise ValueError("na_policy should be 'raise' or 'drop'")
    seen = points.agg(
        F.count_if(bad).alias("bad"), F.min(F.size("features")).alias("low"), F.max(F.size("features")).alias("high")
    ).first()
    if seen.bad:
        raise ValueError(f"{seen.bad} rows have missing or non-finite values")
    if seen.low != seen.high:
        raise ValueError(f"rows differ in width: {seen.low} to {seen.high}")
    return points


def scaler_fit(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row ``mean``, ``scale`` (arrays): population deviation, 1 for constant columns."""
    cols = [F.col(f"`{c}`").cast("double") for c in features]
    deviations = [F.stddev_pop(c) for c in cols]
    return df.agg(
        F.array(*[F.avg(c) for c in cols]).alias("mean"),
        F.array(*[F.when(s == 0, 1.0).otherwise(s) for s in deviations]).alias("scale"),
    )


def scaler_fit_vectors(points: DataFrame) -> DataFrame:
    """The same for an array column: one pass, one sum per position."""
    width = points.select(F.size("features")).first()[0]
    flat = points.select(*[F.col("features")[i].alias(f"f{i}") for i in range(width)])
    return scaler_fit(flat, flat.columns)


def scaler_apply(points: DataFrame, scaler: DataFrame) -> DataFrame:
    """Standardise ``points`` with a one-row scaler.

    The row's numbers become literals of one compiled projection; very wide
    vectors take them from a broadcast row instead.
    """
    row = scaler.select("mean", "scale").first()
    if len(row["mean"]) <= WIDE:
        vector = F.col("features")
        z = [(vector[n] - F.lit(m)) / F.lit(s) for n, (m, s) in enumerate(zip(row["mean"], row["scale"]))]
        return points.withColumn("features", F.array(*z))
    joined = points.join(F.broadcast(scaler.select("mean", "scale")))
    z = F.transform("features", lambda v, i: (v - F.get("mean", i)) / F.get("scale", i))
    return joined.withColumn("features", z).drop("mean", "scale")


def attach(embedding: DataFrame, source: DataFrame, id_col: str, target: str) -> DataFrame:
    """Bring the target back to the embedding as a text label."""
    labels = source.select(F.col(id_col).alias("id"), F.col(target).cast("string").alias(target))
    return embedding.join(labels, "id", "left")
