"""Quality classifier without hand labels.

Heuristic labellers look at a text and say good, bad or nothing. How often each
is right follows from how they agree: expectation-maximisation over the counts
of vote patterns, of which there are at most three to the power of the number
of labellers however many documents there are. The posterior of each pattern
labels a bounded sample, on which a linear scorer over hashed words and word
shapes is trained; it then scores every document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mixing import draw
from .quality_rules import describe
from .util import small_batches, steps

#: Documents that the scorer is trained on, at most; the votes of all documents are counted.
SAMPLE = 8192
#: Slots for hashed features; passes over the sample; rows of one step; learning rate; ridge.
SLOTS, EPOCHS, STEP_ROWS, RATE, RIDGE = 1 << 15, 12, 64, 2.0, 1e-6
#: A document is kept from this score on.
KEEP = 0.4
#: Share of good documents believed beforehand.
GOOD_SHARE = 0.8
GOOD, BAD, SILENT = "g", "b", "-"


_PLAIN = re.compile(r"(?<![^ \t\n\v\f\r])[^\W\d_]+[.,;:!?]?(?![^ \t\n\v\f\r])")
LABELLERS = ("symbols", "repeats", "lines", "capitals", "lengths", "plain", "fresh", "calm")


def vote(text: str | None) -> str:
    """A character for each of ``LABELLERS``. Faults are named or passed over; soundness is named where there is enough to see."""
    n, chars, symbols, dups, again, lines, upper = describe(text)
    if not n:
        return BAD + SILENT * (len(LABELLERS) - 1)
    symbols, dups, again, upper, length = symbols / chars, dups / lines, again / n, upper / n, chars / n
    plain = len(_PLAIN.findall(text)) / n
    votes = (
        BAD if symbols > 0.05 else SILENT,
        BAD if again > 0.4 else SILENT,
        BAD if dups > 0.4 else SILENT,
        BAD if upper > 0.4 and n > 4 else SILENT,
        BAD if length > 14 or length < 1.5 else SILENT,
        GOOD if plain >= 0.9 else BAD if plain < 0.6 else SILENT,
        GOOD if again < 0.1 and dups < 0.1 and symbols < 0.05 and n >= 30 else SILENT,
        GOOD if symbols < 0.01 and upper < 0.1 else SILENT,
    )
    return "".join(votes)


def voted(text: Column) -> Column:
    return F.pandas_udf(lambda texts: texts.map(vote), "string")(text)


def estimate(counts: dict[str, int], share: float = GOOD_SHARE, rounds: int = 500) -> dict[str, float]:
    """Posterior of good for each vote pattern.

    A labeller that speaks is right with a chance of its own, whatever the
    document; its silence says nothing. The chances follow by
    expectation-maximisation, from the majority of the votes and the believed
    ``share`` of good documents, which votes of one kind cannot tell. An
    imagined tenth of the documents, on which labellers are right nine times
    in ten, keeps a labeller that hardly speaks from being turned around.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    good = np.array([[c == GOOD for c in p] for p in patterns], float)
    bad = np.array([[c == BAD for c in p] for p in patterns], float)
    post = (good.sum(1) + 1) / (good.sum(1) + bad.sum(1) + 1.2)
    spoken = n @ (good + bad)
    imagined = 1 + 0.1 * spoken
    for _ in range(rounds):
        right = (n * post) @ good + (n * (1 - post)) @ bad
        chance = np.clip((right + 0.9 * imagined) / (spoken + imagined), 0.55, 0.995)
        weight = np.log(chance / (1 - chance))
        new = 1 / (1 + np.exp(-np.clip(math.log(share / (1 - share)) + good @ weight - bad @ weight, -50, 50)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return dict(zip(patterns, post.tolist(), strict=True))


_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


def _slots(word: bytes) -> int:
    """Two slots, of the lowered word and of its shape, in one number."""
    text = word.decode("utf-8", "replace")
    shape = _DIGITS.sub("0", _LETTERS.sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", text))
    one = xxhash.xxh3_64_intdigest(text.lower().encode()) % SLOTS
    return one << 32 | xxhash.xxh3_64_intdigest(b"shape:" + shape.encode()) % SLOTS


class Features:
    """Hashed word and shape counts of a text, scaled to length 1; slots of words seen are remembered."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.encode("utf-8", "surrogatepass").split() if text else []
        if len(self.known) > 200_000:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = _slots(w)
        both = np.fromiter((known[w] for w in words), np.int64, len(words))
        slots, counts = np.unique(np.concatenate([both >> 32, both & 0xFFFFFFFF]), return_counts=True)
        values = np.log1p(counts)
        return slots, values / max(1e-12, np.sqrt((values * values).sum()))


def train(rows: list[tuple[np.ndarray, np.ndarray]], goal: np.ndarray) -> np.ndarray:
    """Weights and, last, the offset of a logistic scorer; both classes weigh the same, steps in a fixed order."""
    weights = np.zeros(SLOTS + 1)
    if not rows:
        return weights
    mass = np.array([max(1e-3, (1 - goal).mean()), max(1e-3, goal.mean())])
    order = np.random.default_rng(3).permutation(len(rows))
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for at in range(0, len(order), STEP_ROWS):
            part = order[at : at + STEP_ROWS]
            slots = np.concatenate([rows[k][0] for k in part])
            values = np.concatenate([rows[k][1] for k in part])
            owner = np.repeat(np.arange(len(part)), [len(rows[k][0]) for k in part])
            raw = np.bincount(owner, weights[slots] * values, len(part)) + weights[-1]
            p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            y = goal[part]
            slope = (y * (p - 1) / mass[1] + (1 - y) * p / mass[0]) / 2
            weights[:-1] -= rate * (np.bincount(slots, values * slope[owner], SLOTS) / len(part) + RIDGE * weights[:-1])
            weights[-1] -= rate * slope.mean()
    return weights


def classify(docs: DataFrame, sample: int = SAMPLE, keep: float = KEEP, label: str = "classifier") -> DataFrame:
    """``docs`` with ``__votes``, ``__posterior``, ``__score`` and ``__kept``.

    Needs ``text``. Null and empty texts have no words: they are voted on as
    short and scored by the offset alone. Votes belong to texts, so rows with
    equal texts, whatever their ids, vote and score alike, and each text is
    drawn once at most. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    store = steps(spark, label)
    mark = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    told = store.save(docs.select(mark.alias("mark"), voted(F.coalesce(F.col("text"), F.lit(""))).alias("votes")), "votes")
    patterns = told.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))  # at most 3 ** labellers rows
    posterior = estimate({r["votes"]: r["n"] for r in patterns.collect()})
    texts = store.save(told.groupBy("mark").agg(F.min("votes").alias("votes")), "texts")

    total = texts.count()
    drawn = texts.withColumn("draw", draw(F.hex("mark"), F.lit(""), 23))
    drawn = drawn.filter(F.col("draw") < int(min(1.0, 1.5 * sample / max(1, total) + 1e-9) * (1 << 52)))
    picked = F.broadcast(store.save(drawn.orderBy("draw", "mark").limit(sample), "picked"))
    rows = docs.select(mark.alias("mark"), "text").join(picked, "mark").groupBy("mark", "votes", "draw").agg(F.min("text").alias("text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, seen, goal = Features(), [], []
        for batch in batches:
            for text, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.append(features(text))
                goal.append(posterior[said])
        yield pa.record_batch([pa.array([train(seen, np.asarray(goal)).tolist()], pa.list_(pa.float64()))], names=["weights"])

    # One task reads the sample, which is bounded.
    ordered = rows.coalesce(1).sortWithinPartitions("draw", "mark").select("text", "votes")
    model = store.save(ordered.mapInArrow(learn, "weights array<double>"), "model").first()
    weights = np.asarray(model["weights"] if model else np.zeros(SLOTS + 1), np.float32)

    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in batches:
            raw = [float(weights[slots] @ values) + float(weights[-1]) for slots, values in map(features, texts)]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.asarray(raw, float), -30, 30))))

    score = F.pandas_udf(rate, "double")
    known = F.create_map(*[F.lit(x) for pair in posterior.items() for x in pair]).cast("map<string,double>")
    scored = docs.withColumn("__score", score(F.col("text"))).withColumn("__mark", mark)
    # A text's votes are looked up; of many copies of one text adaptive execution splits the rows.
    out = scored.join(texts.select(F.col("mark").alias("__mark"), F.col("votes").alias("__votes")), "__mark").drop("__mark")
    out = out.withColumn("__posterior", F.try_element_at(known, F.col("__votes")))
    return out.withColumn("__kept", F.col("__score") >= keep)


def query(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return classify(docs).select("doc_id", F.col("__votes").alias("votes"), F.col("__posterior").alias("posterior"), F.col("__score").alias("score"), F.col("__kept").alias("kept"))
