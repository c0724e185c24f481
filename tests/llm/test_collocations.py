import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from llm_texts import prose

from lowfold.llm import collocations, util

SIGNS = re.compile(r"[.,;:!?\x0A-\x0D]")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least, top, cover=80):
    f, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in SIGNS.split((text or "").translate({c: c + 32 for c in range(65, 91)})):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in range(1, 5):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: n for p, n in counts.items() if len(p) > 1 and n >= least}
        most = Counter()
        for p, n in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], n)
        rows = []
        for p, a in cands.items():
            if 100 * most[p] >= cover * a:
                continue
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, total[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def corpus():
    draw = random.Random(11)
    docs = []
    for k in range(150):
        lang = draw.choice(["en", "de", None, "und"])
        words = [f"w{min(draw.randrange(30), draw.randrange(30))}" for _ in range(draw.randrange(1, 200))]
        text = "".join(w.capitalize() + draw.choice([" ", " ", " ", "\t", ". ", "\n", " , "]) for w in words)
        if k % 3 == 0:
            text += " the long shared passage of words that goes on Étoile and on to its very end"
        if k % 5 == 0:
            text += ": x x x x x x x x"
        docs.append((text, lang))
    return [*docs, (None, "en"), ("", None), ("...", "fr"), ("a\x1cb\xa0c d " * 20, "fr"), (docs[0][0], docs[0][1])]


@pytest.mark.parametrize("slots,chunk,part,small", [(1 << 25, 2_000_000, 30_000, 100_000), (1 << 25, 500, 7, 0), (1 << 15, 10, 50, 100_000)])
def test_equals_brute_force(spark, monkeypatch, slots, chunk, part, small):
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(collocations, "SLICE_WORDS", part)
    monkeypatch.setattr(util, "SMALL_ROWS", small)
    docs = corpus()
    df = spark.createDataFrame(docs, "text STRING, lang STRING").withColumn("phrase", df_null()).withColumn("n", df_null())
    got = collocations.collocations(df, least=8, top=40, slots=slots)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(docs, 8, 40)


def df_null():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_graph(spark):
    docs = corpus()
    graph = collocations.Graph(spark.createDataFrame(docs, "text STRING, lang STRING"), least=5, label="graph")
    f, inner, edges = defaultdict(Counter), set(), Counter()
    for text, lang in docs:
        for piece in SIGNS.split((text or "").translate({c: c + 32 for c in range(65, 91)})):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    want = {(lang, " ".join(p), len(p), n) for lang, counts in f.items() for p, n in counts.items() if n >= 5}
    assert {tuple(r) for r in graph.counts.collect()} == want
    paths = graph.paths.collect()
    for r in paths:
        ws = r.phrase.split(" ")
        assert len(ws) == r.edges + 3
        for k in range(r.edges):
            edges[r.lang, tuple(ws[k : k + 4])] += 1
            assert f[r.lang][tuple(ws[k : k + 4])] == r.n
        inner |= {(r.lang, " ".join(ws[k : k + 3])) for k in range(1, r.edges)}
    assert edges == Counter({(lang, p): 1 for lang, counts in f.items() for p, n in counts.items() if n >= 5 and len(p) == 4})
    assert inner == {tuple(r) for r in graph.inner.collect()}
    assert max(r.edges for r in paths) == 13


def test_large_counts_are_exact(spark):
    rows = [(9_000_000_000_000, 10_000_000_000_001, 9_000_000_000_007), (3 << 60, 3 << 60, 3 << 60), (30, 31, 40)]
    got = spark.createDataFrame(rows, "a LONG, l LONG, r LONG").withColumn("s", collocations._exact("2000000 * [a] div ([l] + [r])").cast("long")).collect()
    assert [r.s for r in got] == [2000000 * a // (x + y) for a, x, y in rows]


def test_sql_twin(spark):
    words = prose(4, 4000, 12).replace(".", "").split()
    docs = pd.DataFrame({"text": [" ".join(words), prose(5, 3000, 9), None], "lang": ["en", None, "de"]})
    con = duckdb.connect()
    con.register("documents", docs)
    got = collocations.collocations(spark.createDataFrame(docs.astype(object).where(docs.notna(), None), "text STRING, lang STRING"))
    want = [tuple(x if isinstance(x, str) else int(x) for x in r) for r in con.execute(collocations.ORACLE).fetchall()]
    assert got.count() > 20 and sorted(map(tuple, got.collect())) == sorted(want) == brute(docs.replace({np.nan: None}).itertuples(index=False, name=None), 30, 2000)


def test_odd_tables(spark, odd_docs, no_docs):
    assert collocations.collocations(no_docs).count() == 0
    rows = [(r.text, r.lang) for r in odd_docs.select("text", "lang").collect()]
    assert sorted(map(tuple, collocations.collocations(odd_docs, least=3).collect())) == brute(rows, 3, 2000)
