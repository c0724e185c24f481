import numpy as np
import pytest

from lowfold.llm import near_dedup

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, cid STRING, n STRING"


def vectors():
    draw = np.random.default_rng(8)
    rows = [(k, draw.normal(size=16), k % 3) for k in range(200)]
    base = draw.normal(size=16)
    rows += [(200 + k, base + draw.normal(size=16) * 0.1 * (k % 4) / 3, 1) for k in range(150)]  # a group of near copies
    rows += [(350 + k, base, 1) for k in range(40)] + [(390, base * 5, 1), (391, base, 2), (392, base, None), (393, -base, 1)]
    rows = [(i, [float(np.float32(c)) for c in x], label) for i, x, label in rows]
    rows += [(394, None, 1), (395, [0.0] * 16, 1), (396, [1.0, None] * 8, 1), (397, [float("nan")] * 16, 1), (398, [float("inf")] * 16, 1), (399, [], 1), (400, [1.0, 2.0], 1), (401, [2.0, 4.0], 1)]
    return rows


def brute(rows):
    """Links and smallest id reached, over all pairs."""
    ok = [(i, np.asarray(x, float), label) for i, x, label in rows if label is not None and x and None not in x and np.isfinite(x).all() and np.any(x)]
    links = {i: set() for i, *_ in rows}
    for a, x, la in ok:
        for b, y, lb in ok:
            if a != b and la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[a].add(b)
    reach = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        reach[i] = min(seen)
    return links, reach


@pytest.mark.parametrize("block", [1024, 16])
def test_links_against_all_pairs(spark, block):
    rows = vectors()
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(5)
    links, reach = brute(rows)
    got = {r.vec_id: r for r in near_dedup.near_duplicates(table, block=block).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links <= len(links[i]) for i in links)
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(map(len, links.values()))
    assert np.mean([got[i].component_id == reach[i] for i in reach]) > 0.99
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    for i in range(392, 400):
        assert (got[i].n_links, got[i].component_id) == (0, i) or i == 393
    assert got[401].component_id == 400


def test_blocks_do_not_change_the_links(spark):
    table = spark.createDataFrame([(*r, "c", "c") for r in vectors()], SCHEMA)
    one, many = ({r.vec_id: (r.n_links, r.component_id) for r in near_dedup.near_duplicates(table, block=b).collect()} for b in (1024, 8))
    assert one == many


def test_repeated_rows_and_empty_tables(spark):
    x = [1.0, 2.0, 3.0]
    table = spark.createDataFrame([(1, x, 1, "", ""), (1, x, 1, "", ""), (None, x, 1, "", "")], SCHEMA)
    assert sorted((r.n_links, r.component_id) for r in near_dedup.near_duplicates(table).collect()) == [(2, 1)] * 3
    assert near_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
