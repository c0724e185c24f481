import random
import re

import pytest
from llm_texts import prose

from lowfold.llm import ngram_join, util

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, size, percent):
    """(n, smallest id reached) by comparing all pairs."""
    sets = {}
    for k, t in texts.items():
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    top = {k: k for k in sets}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in ids}


def edited(words, share, seed):
    draw = random.Random(seed)
    return " ".join(f"e{seed}x{k}" if draw.random() < share else w for k, w in enumerate(words))


def corpus():
    texts = {}
    passage = prose(1234, 60)
    for k in range(120):  # a passage that many documents share
        texts[len(texts)] = f"{prose(k + 5000, 70)} {passage} {prose(k + 9000, 40)}"
    base = prose(77, 160).split()
    for k in range(150):  # a large group of near copies, edited more or less
        texts[len(texts)] = edited(base, (k % 10) / 60, k)
    for k in range(60):  # pairs on either side of the bound, and parts of texts
        words = prose(300 + k, 40 + k).split()
        texts[len(texts)] = " ".join(words)
        texts[len(texts)] = edited(words, 0.03 + (k % 5) / 100, 1000 + k)
        texts[len(texts)] = " ".join(words[: -(1 + k % 12)])
    for t in ("", " \n", "One two", "one TWO", "one two three four", "ONE two three four"):
        texts[len(texts)] = t
    return texts


@pytest.mark.parametrize("common", [3, 32])
def test_against_all_pairs(spark, monkeypatch, common):
    monkeypatch.setattr(ngram_join, "COMMON", common)
    texts = corpus()
    rows = [(k, t if k != 3 else t, "clash", "clash") for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, cid STRING, n STRING").repartition(7)
    got = {r.doc_id: (r.n, r.component_id) for r in ngram_join.near_copies(docs).collect()}
    assert got == brute(texts, 4, 85)


def test_odd_rows(odd_docs, no_docs):
    rows = ngram_join.near_copies(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    reach = {}
    for r in rows:
        reach.setdefault(r.doc_id, set()).add((r.n > 0, r.component_id))
    assert reach[40] == {(False, 40)} and reach[41] == {(False, 41)} and reach[42] == {(False, 42)}
    assert reach[45] == reach[46] == reach[5] == {(True, 5)} and reach[49] == {(True, 48)} and reach[None] == {(True, 3)} and reach[47] == {(True, 7)}
    assert ngram_join.near_copies(no_docs).count() == 0


def test_one_of_each_stays(odd_docs):
    out = ngram_join.one_of_each(odd_docs, size=4, percent=85)
    assert out.columns == odd_docs.columns
    ids = {r.doc_id for r in out.collect()}
    assert {5, 7, 48, 40, 41, 42, 43, 44} <= ids and not ids & {45, 46, 47, 49}


def test_one_row_of_each_group(spark):
    a, b, c, d, e = (prose(k, 80) for k in range(601, 606))
    rows = [(1, a, "x"), (2, a + " more", "x"), (2, b, "x"), (3, b, "x"), *[(None, a, "x")] * 3, *[(4, d, "x")] * 50, *[(None, e, "x")] * 20, (None, e, "w")]
    rows += [(5, c + " more", None)] * 2 + [(None, c, "x")] * 40 + [(6, "", "x")] * 2 + [(6, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, name STRING").repartition(5)
    got = [tuple(r) for r in ngram_join.one_of_each(docs).collect()]
    # One of each group, a row without id only where no other has one; rows without words are in no group.
    want = [(1, a, "x"), (2, b, "x"), (4, d, "x"), (5, c + " more", None), (None, e, "w"), (6, "", "x"), (6, "", "x"), (6, None, "x")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_joins_agree_beyond_the_broadcast_size(spark, monkeypatch):
    monkeypatch.setattr(util, "SMALL_ROWS", 0)
    texts = {k: t for k, t in corpus().items() if k % 3 or k >= 270}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    got = {r.doc_id: (r.n, r.component_id) for r in ngram_join.near_copies(docs).collect()}
    assert got == brute(texts, 4, 85)


def test_many_texts_under_one_id(spark):
    """Rows without id, or with the same one, are fetched by their texts, so 6,000 of them never meet each other."""
    rows = [(None if k < 1500 else 1, t) for k in range(3000) for t in (prose(k, 40), prose(k, 40) + " more")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    left = [tuple(r) for r in ngram_join.one_of_each(docs).collect()]
    assert len(left) == 3000 and len({t.removesuffix(" more") for _, t in left}) == 3000
    assert {r.component_id for r in ngram_join.near_copies(docs).collect()} == {None, 1}


def test_shingles_of_many_texts(monkeypatch):
    """Texts mixed in one go have the sets that each has alone, also odd ones and those around the end of a go."""
    texts = ["One two three", None, "", " \n\t", "a", prose(1, 300), "\ud800 b c d e", *(prose(k, k % 9) for k in range(60)), "one TWO three", None]
    alone = [next(iter(ngram_join.shingles([t], 4))).tolist() for t in texts]
    for words in (1, 7, 40, 1 << 20):
        monkeypatch.setattr(ngram_join, "MIXED_WORDS", words)
        assert [s.tolist() for s in ngram_join.shingles(texts, 4)] == alone
    assert alone[0] == alone[-2] and [len(s) for s in alone[:5]] == [1, 0, 0, 0, 1] and alone[5] == sorted(set(alone[5]))
    assert [*ngram_join.shingles([], 4)] == []


def test_steps_of_the_join(spark, monkeypatch):
    """Postings meet without being gathered into lists, and each search for pairs fetches its documents once; rows without id or text and copies stay as they were."""
    saved = []
    save = ngram_join._Join.save

    def seen(self, df, name):
        saved.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return save(self, df, name)

    monkeypatch.setattr(ngram_join, "COMMON", 3)
    monkeypatch.setattr(ngram_join._Join, "save", seen)
    texts = corpus()
    rows = [*texts.items(), *[(7, texts[7])] * 3, (None, texts[130]), (None, None), (None, ""), (500, None)]
    got = ngram_join.near_copies(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)).collect()
    want = brute(texts, 4, 85)
    assert len(got) == len(rows) and all((r.n, r.component_id) == want[r.doc_id] for r in got if r.doc_id in texts)
    assert sorted(((r.n, r.component_id) for r in got if r.doc_id not in texts), key=str) == sorted([want[130], (0, None), (0, None), (0, 500)], key=str)
    plans = dict(saved)
    assert "collect_list" not in plans["product"] and [name for name, _ in saved].count("tokens") == 3
