"""Quality rules: fixed floors, then robust multivariate outliers.

Each document that passes the floors becomes a vector of transformed text
statistics. Minimum-covariance-determinant estimates of centre and spread,
one for each language and source, come from concentration steps: the rows
are aggregated by bin of distance, and the nearest three quarters give the
next estimate. Each group starts from its medians, from its means and from the
rows near its medians by rank, runs until its determinants stand still, and
keeps the estimate of least determinant. A document far from its group's
centre is rejected.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import small_batches, steps, with_small

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: Share of a group that the estimate rests on, most concentration steps, rows a group needs for an estimate of its own.
KEEP, ROUNDS, MIN_ROWS = 0.75, 12, 200
#: Steps end where no group's best determinant falls by more than this share.
STILL = 1e-3
#: Least standard deviation in any direction, in units of FLOORS: a smaller one is lifted to it, a larger one left alone.
FLOORS = (0.12, 0.045, 0.2, 0.12, 0.16)
#: Tail of the chi-square distribution beyond which a document is rejected.
TAIL = 1e-5
DIM = len(FLOORS)
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long"


def _repeated(ids: np.ndarray) -> int:
    """Words inside windows of three that occur twice or more."""
    if len(ids) < 4:
        return 0
    width = int(ids.max()) + 1
    if width < 1 << 21:
        windows = (ids[:-2] * width + ids[1:-1]) * width + ids[2:]
        _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        windows = np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1)
        _, place, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    twice = count[place.reshape(-1)] > 1
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : len(ids) - 2 + shift] |= twice
    return int(inside.sum())


_SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
_SPACE = " \t\n\v\f\r"


def describe(text: str | None) -> tuple[int, ...]:
    """The numbers of ``STATS`` for one text; a null text has none of anything."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return (0, 0, len(_SYMBOL.findall(text or "")), 0, 0, 0, 0)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    return (
        len(words), len(text) - sum(text.count(c) for c in _SPACE), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)),
        _repeated(ids), len(lines), sum(map(str.isupper, text.split())),
    )


def statistics(text: Column) -> Column:
    """``describe`` as a column."""

    @F.pandas_udf(STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        rows = [describe(t) for t in texts]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in STATS.split(", ")], dtype="int64")

    return stats(text)


def floors_failed(s: str = "") -> Column:
    n, again = F.col(f"{s}n_words"), F.col(f"{s}n_repeat_words")
    return (n < MIN_WORDS) | (100 * again > 50 * n)


def transformed(s: str = "") -> list[Column]:
    """The statistic vector: word length, symbols, repeated lines, repeated words, words in capitals."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{s}{part}"), F.col(f"{s}{whole}")), F.lit(0.0)).cast("double")

    length = F.log(F.greatest(share("word_chars", "n_words"), F.lit(1.0)))
    root = lambda x: F.asin(F.sqrt(F.least(x, F.lit(1.0))))
    return [length, root(share("n_symbols", "word_chars")), root(share("n_dup_lines", "n_lines")), root(share("n_repeat_words", "n_words")), root(share("n_upper", "n_words"))]


def chi_square(p: float, dim: int) -> float:
    """Upper quantile of the chi-square distribution, by bisection of its incomplete gamma integral."""

    def upper(x: float) -> float:
        a, x = dim / 2, x / 2
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1 - total * math.exp(a * math.log(x) - x - math.lgamma(a))

    def tail(x: float) -> float:
        if x / 2 < dim / 2 + 10:
            return upper(x)
        a, y, total, term = dim / 2, x / 2, 1.0, 1.0  # asymptotic beyond, where the difference to 1 would cancel
        for j in range(1, 12):
            term *= (a - j) / y
            if abs(term) < 1e-17 or a - j == 0:
                break
            total += term
        return total * math.exp((a - 1) * math.log(y) - y - math.lgamma(a))

    low, high = 1e-9, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) > p else (low, mid)
    return high


X = [f"x{i}" for i in range(DIM)]
PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
FIT = "grp string, start int, centre array<double>, precision array<double>, stretch double, size double"


def _distance() -> Column:
    gap = [F.col(x) - F.col("centre")[i] for i, x in enumerate(X)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + (1.0 if i == j else 2.0) * F.col("precision")[i * DIM + j] * gap[i] * gap[j]
    return F.greatest(total, F.lit(0.0))


def lifted(spread: np.ndarray) -> np.ndarray:
    """``spread`` with its variances along its own axes, in units of ``FLOORS``, lifted to 1 where they are less."""
    unit = np.array(FLOORS)
    values, axes = np.linalg.eigh(spread / np.outer(unit, unit))
    return (axes * np.maximum(values, 1.0)) @ axes.T * np.outer(unit, unit)


def _row(grp: str, start: int, centre: np.ndarray, spread: np.ndarray, stretch: float) -> pd.DataFrame:
    """One estimate; ``size`` is the logarithm of its determinant."""
    spread = lifted(spread)
    size = float(np.linalg.slogdet(spread)[1])
    precision = np.linalg.inv(spread).ravel().tolist()
    return pd.DataFrame({"grp": [grp], "start": [start], "centre": [centre.tolist()], "precision": [precision], "stretch": [stretch], "size": [size]})


def _starts(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
    """Medians and their spreads, means and variances, and means and variances of each statistic's middle half."""
    centre, spread = np.zeros((3, DIM)), np.zeros((3, DIM))
    for i, part in bins.groupby("dim"):
        part = part.sort_values("bin")
        value, n = part["bin"].to_numpy() / 128.0, part["n"].to_numpy(float)

        def median(v: np.ndarray, n: np.ndarray = n) -> float:
            order = np.argsort(v, kind="stable")
            return v[order][np.searchsorted(n[order].cumsum(), n.sum() / 2)]

        upto = n.cumsum()
        middle = np.clip(np.minimum(upto, 0.75 * upto[-1]) - np.maximum(upto - n, 0.25 * upto[-1]), 0, None)
        centre[:, i] = median(value), np.average(value, weights=n), np.average(value, weights=middle)
        spread[:, i] = (1.4826 * median(np.abs(value - centre[0, i]))) ** 2, np.average((value - centre[1, i]) ** 2, weights=n), np.average((value - centre[2, i]) ** 2, weights=middle)
    return pd.concat([_row(key[0], k, centre[k], np.diag(spread[k]), 1.0) for k in range(3)])


def _concentrate(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
    """Centre and spread of the nearest rows, from sums by bin of distance; the bin in which they end counts whole."""
    bins = bins.sort_values("bin")
    upto = bins["n"].to_numpy().cumsum()
    end = int(np.searchsorted(upto, KEEP * upto[-1]))
    near = bins.iloc[: end + 1]
    n = float(upto[end])
    centre = near[[f"s{i}" for i in range(DIM)]].sum().to_numpy() / n
    spread = np.zeros((DIM, DIM))
    for i, j in PAIRS:
        spread[i, j] = spread[j, i] = near[f"q{i}_{j}"].sum() / n - centre[i] * centre[j]
    # The nearest rows are less spread than all: what they lack is read off the distance at which they end.
    reach = math.expm1(float(bins["bin"].iloc[end] + 1) / 32)
    return _row(key[0], int(key[1]), centre, spread, max(1.0, reach / chi_square(1 - KEEP, DIM)))


def _group(spark_rows: DataFrame) -> DataFrame:
    """Rows by language and source; small groups are pooled by language, what stays small after that in one pool."""
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("lang", "source"))
    fine = F.concat_ws("\x1f", lang, source)
    counts = spark_rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("grp", F.when(F.col("n") >= MIN_ROWS, fine).otherwise(lang))
    pooled = counts.groupBy("grp").agg(F.sum("n").alias("pool"))
    counts = counts.join(pooled, "grp").withColumn("grp", F.when(F.col("pool") >= MIN_ROWS, F.col("grp")).otherwise(""))
    return counts.select("lang", "source", "grp")


def fit(stats: DataFrame, label: str = "quality") -> tuple[DataFrame, DataFrame]:
    """``groups(lang, source, grp)`` and the fit of each group, from ``stats(lang, source, <STATS>)`` of all documents."""
    store = steps(stats.sparkSession, label)
    sound = stats.filter(~floors_failed()).select("lang", "source", *[x.alias(X[i]) for i, x in enumerate(transformed())])
    sound = store.save(sound, "sound")
    groups = store.save(_group(sound), "groups")
    n_groups = groups.count()
    rows = store.save(_with_group(sound, groups, n_groups, "grp").select("grp", *X), "grouped")
    melted = rows.select("grp", F.posexplode(F.array(*X)).alias("dim", "x")).withColumn("bin", F.round(F.col("x") * 128).cast("long"))
    found = melted.groupBy("grp", "dim", "bin").agg(F.count(F.lit(1)).alias("n")).groupBy("grp").applyInPandas(_starts, FIT)
    found = store.save(found, "start")
    for k in range(ROUNDS):
        before = found.groupBy("grp").agg(F.collect_list(F.struct("start", "centre", "precision")).alias("fits"))
        placed = with_small(rows, before, ["grp"], rows=n_groups).select("grp", *X, F.explode("fits").alias("fit")).select("grp", *X, "fit.*")
        placed = placed.withColumn("bin", F.floor(F.log1p(_distance()) * 32))
        sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)] + [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}_{j}") for i, j in PAIRS]
        bins = placed.groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *sums)
        new = store.save(bins.groupBy("grp", "start").applyInPandas(_concentrate, FIT), f"fit{k}")
        least = found.groupBy("grp").agg(F.min("size").alias("was")).join(new.groupBy("grp").agg(F.min("size").alias("size")), "grp")
        found = new
        # The starts' own determinants are of all rows, so the first step compares with nothing.
        if k and not least.filter(F.abs(F.col("was") - F.col("size")) > STILL).limit(1).count():
            break
    best = found.groupBy("grp").agg(F.min_by(F.struct("centre", "precision", "stretch"), F.struct("size", "start")).alias("fit"))
    return groups, store.save(best.select("grp", "fit.*"), "least")


def _with_group(rows: DataFrame, groups: DataFrame, n_groups: int, name: str) -> DataFrame:
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("lang", "source"))
    key = F.concat_ws("\x1f", lang, source)
    side = groups.select(key.alias("__key"), F.col("grp").alias(name))
    return with_small(rows.withColumn("__key", key), side, ["__key"], "left", n_groups).drop("__key")


def judged(docs: DataFrame, label: str = "quality") -> DataFrame:
    """``docs(text, lang, source, ...)`` with ``__q`` (the statistics), ``__failed``, ``__distance`` and ``__kept``.

    A null text counts as empty and fails the floors; null languages and
    sources are groups of their own; without documents that pass there is no
    estimate and nothing to judge. Rows that are equal get equal verdicts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stats = docs.select("lang", "source", statistics(F.col("text")).alias("q")).select("lang", "source", "q.*")
    groups, found = fit(stats, label)
    n_groups = groups.count()
    verdicts = groups.join(F.broadcast(found) if n_groups <= 100_000 else found, "grp").select(
        *[F.col(c) for c in ("lang", "source")], F.struct("centre", "precision", "stretch").alias("grp")
    )
    verdicts = steps(spark, label).save(verdicts, "verdicts")
    rows = docs.select(*[F.col(c) for c in docs.columns], statistics(F.col("text")).alias("__q"))
    rows = _with_group(rows, verdicts, n_groups, "__fit")
    vector = F.struct(*[x.alias(X[i]) for i, x in enumerate(transformed("__q."))])
    gap = [vector[x] - F.col("__fit.centre")[i] for i, x in enumerate(X)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + (1.0 if i == j else 2.0) * F.col("__fit.precision")[i * DIM + j] * gap[i] * gap[j]
    rows = rows.withColumn("__failed", floors_failed("__q.")).withColumn("__distance", total / F.col("__fit.stretch"))
    near = F.coalesce(F.col("__distance") <= chi_square(TAIL, DIM), F.lit(True))
    return rows.withColumn("__kept", ~F.col("__failed") & near).drop("__fit")


def kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    return judged(docs, "quality-stage").filter("__kept").select(*docs.columns)


def query(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    out = judged(docs)
    numbers = [F.col(f"__q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("doc_id", *numbers, F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept"), F.col("__distance").alias("distance"))
