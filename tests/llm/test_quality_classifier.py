import numpy as np
import pandas as pd

from lowfold.llm import quality_classifier as qc

SF = "/root/testdata/sf0.01"


def test_estimated_chances_recover_the_truth():
    """Labellers that are right 70 to 95 times in a hundred, independently."""
    draw = np.random.default_rng(6)
    good = draw.random(20_000) < 0.8
    right = [0.95, 0.9, 0.8, 0.75, 0.7]
    said = np.stack([np.where(draw.random(len(good)) < 0.25, "-", np.where((draw.random(len(good)) < p) == good, "g", "b")) for p in right])
    patterns = ["".join(v) for v in said.T]
    posterior = qc.estimate(pd.Series(patterns).value_counts().to_dict())
    guess = np.array([posterior[p] > 0.5 for p in patterns])
    spoken = (said == "g").sum(0) + (said == "b").sum(0) > 0
    majority = (said == "g").sum(0) >= (said == "b").sum(0)
    assert (guess == good)[spoken].mean() > max(0.92, (majority == good)[spoken].mean())
    assert qc.estimate({}) == {}


def test_features_and_votes():
    features = qc.Features()
    slots, values = features("One two two ### ABC")
    assert abs((values**2).sum() - 1) < 1e-9 and (np.diff(slots) > 0).all()
    assert len(features(None)[0]) == 0 and len(features("")[0]) == 0
    assert qc.vote(None) == qc.vote("") == qc.vote(" \n") and set(qc.vote("a b c")) <= set("gb-")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = qc.classify(docs, sample=300).select("doc_id", "__score", "__kept", "__posterior").toPandas()
    assert len(got) == docs.count()
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    both = got.merge(labels, on="doc_id")
    good = both.quality == 1
    assert (both["__kept"] == good).mean() > 0.92
    assert both["__kept"][good].mean() > 0.98
    again = qc.classify(docs.repartition(3), sample=300).select("doc_id", "__score").toPandas()
    assert np.allclose(got.sort_values("doc_id")["__score"], again.sort_values("doc_id")["__score"])


def test_odd_rows(odd_docs, no_docs):
    out = qc.classify(odd_docs)
    assert out.columns == [*odd_docs.columns, "__score", "__votes", "__posterior", "__kept"]
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(r["__score"] is not None and r["__posterior"] is not None for r in rows)
    assert qc.classify(no_docs).count() == 0


def test_rows_of_one_id_keep_their_own_votes(spark):
    """Null and repeated ids with different texts: each row's votes are those of its own text."""
    good, bad = "A plain sentence of ordinary words stands here. " * 12, "## 1 $ | " * 40
    rows = [(None, good), (None, bad), (7, good + "So."), (7, bad + "x"), (8, None), (8, "")] * 5
    out = qc.classify(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert len(out) == len(rows) and all(r["__votes"] == qc.vote(r.text) for r in out)
    assert len({(r.text or "", r["__score"]) for r in out}) == 5


def test_the_query_rates_every_row_and_reruns_agree(spark):
    first, again = (sorted(map(tuple, qc.query(spark, SF).collect())) for _ in range(2))
    assert first == again and len(first) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(None not in row for row in first)
