import hashlib
import re

import numpy as np
import pytest
from llm_texts import prose

from lowfold.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    drawn = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = ["", " ", " \t\n", "a", " a", "a ", "a b c", "éé ñ\x1cx", "a <P> b", "a<S>", "x <M>", "<P", "ends with <", "<S", "<<<< <P >", "\x00 \x0b z", "漢字 かな 漢"] + ["ab " * 9]


def test_units():
    for text in [*ODD, prose(1, 50)]:
        want = np.cumsum([len(u.encode()) for u in UNIT.findall(text)]).tolist()
        assert fim.unit_ends(text.encode()).tolist() == want


@pytest.mark.parametrize("limit", [4, 64, 1 << 15])
def test_digests_and_texts(spark, odd_docs, limit):
    rows = [(1000 + k, t) for k, t in enumerate(ODD * 6)] + [(7, "twice there"), (7, "twice there"), (7, "once here"), (None, "no id"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").unionByName(odd_docs.select("doc_id", "text"))
    rows += [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    want = [(i, brute(i, t), t or "") for i, t in rows]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in fim.digests(docs, limit=limit).collect()), key=key)
    assert got == sorted(((i, *b[:4], sha(b[4]), sha(t)) for i, b, t in want), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    texts = fim.transformed(docs, limit=limit).collect()
    assert sorted((tuple(r) for r in texts), key=key) == sorted(((i, *b) for i, b, _ in want), key=key)
    assert sorted(fim.restore(r.output, r.form) for r in texts) == sorted(t for _, _, t in want)


def test_pieces_are_bounded(spark):
    docs = spark.createDataFrame([(k, "é" * 5000 + " " + prose(k, 2000)) for k in range(20)], "doc_id BIGINT, text STRING")
    found = fim.pieces(docs, limit=101).collect()
    assert max(len(r.body) for r in found) <= 101 + len(fim.PREFIX)
    assert all(r.body.decode() is not None for r in found)


def test_one_shuffle(spark, odd_docs):
    plan = fim.digests(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_no_rows(spark, no_docs):
    assert fim.digests(no_docs).count() == 0 and fim.transformed(no_docs).count() == 0
