import re
from collections import Counter, defaultdict

import pytest

from lowfold.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: 3 * sizes[s] for s in capped} | {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_and_copies(odd_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = Counter((r.doc_id, len(WORDS.findall(r.text or ""))) for r in odd_docs.collect())
    assert Counter((r.doc_id, r["size"]) for r in rows) == texts
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 3
    want = water(dict(sizes), (1, 2, 3))
    for r in rows:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_nested_and_repeatable(odd_docs):
    few = {(r.doc_id, r["size"]): r.copies for r in mixing.mix(odd_docs, max_passes=1).collect()}
    rows = mixing.mix(odd_docs.repartition(5)).collect()
    again = {(r.doc_id, r["size"], r.source): r.copies for r in mixing.mix(odd_docs).collect()}
    assert all(again[r.doc_id, r["size"], r.source] == r.copies for r in rows)
    assert set(few.values()) <= {0, 1}


def test_mixed_rows_keep_their_columns(odd_docs):
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    copies = Counter()
    for r in mixing.mix(odd_docs).collect():
        copies[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in out.collect()) == Counter({k: n for k, n in copies.items() if n})


def test_no_documents(no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id BIGINT, text STRING, source STRING")
    assert {(r.doc_id, r.taken, r.target) for r in mixing.mix(docs).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}


def test_the_plan_is_native(odd_docs):
    plan = mixing.mix(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("key", [None, 1])
@pytest.mark.parametrize("same", [False, True])
def test_rows_of_one_id_come_near_their_target(spark, key, same):
    """All rows of a source under one id, with one text or with many, and one of its rows at most beside the target."""
    rows = [(key, " ".join(["w"] * 10) if same else f"{k} " + "w " * 9, "a") for k in range(2000)]
    rows += [(k, "x " * 10, "b") for k in range(2, 3002)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").repartition(7)
    found = mixing.mix(docs).collect()
    taken, want = defaultdict(int), {}
    for r in found:
        taken[r.source] += r.taken
        want[r.source] = r.target
    assert len(found) == 5000 and all(abs(taken[s] - want[s]) <= 5 for s in want), (taken, want)
    assert Counter(r.source for r in mixing.mixed(docs).collect()) == {s: n // 10 for s, n in taken.items()}
