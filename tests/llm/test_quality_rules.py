import re
from collections import Counter

import numpy as np
from llm_texts import prose

from lowfold.llm import quality_rules
from lowfold.llm.quality_rules import chi_square, describe

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            inside |= {k, k + 1, k + 2}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside))


def test_statistics():
    texts = [None, "", "a", "a a a a", "a b c a b c d", "x\ny\nx\n \n\nx", "a b c\x85d", "## *$ |<>&%", prose(1, 500, 5), prose(2, 5000), "\n" * 50, "é\tü\x0b\x0c\r\nz", "l1 b\nl1 b \nl1 b"]
    for t in texts:
        assert describe(t)[:5] == plain(t), t


def test_quantile():
    for p, dim, want in ((0.05, 5, 11.0705), (0.25, 5, 6.6257), (1e-5, 5, 30.8562), (0.01, 3, 11.3449)):
        assert abs(chi_square(p, dim) - want) < 1e-3


def documents():
    draw = np.random.default_rng(2)
    rows = []
    for k in range(600):
        rows.append((k, prose(k, int(draw.integers(60, 400)), 3000), "en" if k % 2 else "de", "s", None))
    for k in range(600, 640):  # signs after most words
        rows.append((k, re.sub(" ", "### ", prose(k, 100, 3000)), "en", "s", None))
    rows += [(640, None, None, None, None), (641, "", "en", "s", None), (642, "word " * 200, "en", "s", None), (643, prose(9, 120), "fr", "t", None), (644, prose(8, 120), None, None, None)]
    return rows


def test_rejects_outliers_and_keeps_the_rest(spark, no_docs):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, grp STRING"
    docs = spark.createDataFrame(documents(), schema)
    rows = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    assert len(rows) == 645
    assert all(rows[k]["__kept"] for k in range(600)) and not any(rows[k]["__kept"] for k in range(600, 643))
    assert [rows[k]["__failed"] for k in (600, 640, 641, 642, 643)] == [False, True, True, True, False]
    assert rows[643]["__kept"] and rows[644]["__kept"]
    twice = quality_rules.kept(docs.unionByName(docs.limit(3)))
    assert twice.columns == docs.columns and twice.count() == 605
    assert quality_rules.kept(no_docs).count() == 0


def test_centre_and_spread_are_those_of_the_nearest_rows():
    """One concentration step against the same step on the rows."""
    import pandas as pd

    draw = np.random.default_rng(4)
    x = draw.normal(size=(400, quality_rules.DIM))
    distance = (x**2).sum(1)
    bins = np.floor(np.log1p(distance) * 32)
    table = pd.DataFrame({"bin": bins, "n": 1} | {f"s{i}": x[:, i] for i in range(quality_rules.DIM)} | {f"q{i}_{j}": x[:, i] * x[:, j] for i, j in quality_rules.PAIRS})
    out = quality_rules._concentrate(("g", 0), table.groupby("bin", as_index=False).sum().sample(frac=1, random_state=1)).iloc[0]
    end = np.sort(bins)[int(np.ceil(quality_rules.KEEP * 400)) - 1]
    near = x[bins <= end]
    assert np.allclose(out.centre, near.mean(0))
    spread = np.cov(near.T, bias=True)  # wider than the least in every direction, so it stays as it is
    assert np.allclose(np.reshape(out.precision, spread.shape), np.linalg.inv(spread))


def test_small_spreads_are_lifted_and_others_left_alone():
    unit = np.array(quality_rules.FLOORS)
    wide = np.diag((3 * unit) ** 2)
    assert np.allclose(quality_rules.lifted(wide), wide)
    assert np.allclose(quality_rules.lifted(np.zeros((5, 5))), np.diag(unit**2))
    wide[2, 2] = 0
    assert np.allclose(np.diag(quality_rules.lifted(wide)), np.where(np.arange(5) == 2, unit**2, 9 * unit**2))


def extreme(kind):
    """Documents that pass the fixed rules and stand out in one statistic only."""
    words = prose(5, 200, 3000).split()
    return {
        "long words": " ".join(w * 3 for w in words),
        "signs": " ".join(w + "##" for w in words),
        "repeated lines": prose(6, 200, 16).replace(".", "").replace(" ", "\n"),  # one word a line
        "repeated words": " ".join(words[:150] + words[:44]),
        "capitals": " ".join(words).upper(),
    }[kind]


KINDS = ("long words", "signs", "repeated lines", "repeated words", "capitals")


def test_each_statistic_alone_rejects(spark):
    rows = [(k, t, lang, source, g) for k, t, lang, source, g in documents()[:600]] + [(1000 + k, extreme(kind), "en", "s", None) for k, kind in enumerate(KINDS)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, grp STRING")
    got = {r.doc_id: (r["__failed"], r["__kept"]) for r in quality_rules.judged(docs).select("doc_id", "__failed", "__kept").collect()}
    for k, kind in enumerate(KINDS):
        assert got.pop(1000 + k) == (False, False), kind
    assert all(keep for _, keep in got.values())


def test_least_determinant_of_all_starts(spark):
    """The kept estimate against concentration steps on the rows themselves, in NumPy."""
    draw = np.random.default_rng(8)
    rows = []
    for _ in range(400):
        n = int(draw.integers(100, 400))
        rows.append(("en", "s", n, int(n * draw.normal(6, 1.5)), int(n * draw.random()), int(draw.integers(0, 8)), int(n * draw.random() * 0.45), 20, int(n * draw.random() * 0.6)))
    stats = spark.createDataFrame(rows, "lang string, source string, " + quality_rules.STATS)
    x = np.array([tuple(r) for r in stats.select(*quality_rules.transformed()).collect()])
    sizes = []
    for k in range(30):
        near = x[np.random.default_rng(k).permutation(400)[:20]]
        for _ in range(40):
            centre, spread = near.mean(0), quality_rules.lifted(np.cov(near.T, bias=True))
            far = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
            near = x[np.argsort(far)[:300]]
        sizes.append(np.linalg.slogdet(quality_rules.lifted(np.cov(near.T, bias=True)))[1])
    _, found = quality_rules.fit(stats)
    (fit,) = found.collect()
    size = -np.linalg.slogdet(np.reshape(fit.precision, (5, 5)))[1]
    # A bin of distance counts whole, so a few rows more than three quarters may be in.
    assert min(sizes) - 0.05 <= size <= min(sizes) + 0.15
