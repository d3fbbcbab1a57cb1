import numpy as np
import pytest

from ledgerlens.llm import graph


def frame(spark, links, names="a long, b long"):
    return spark.createDataFrame([tuple(map(int, x)) for x in links], names)


def roots_of(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


def as_dict(found):
    rows = [tuple(r) for r in found.select("node", "root").collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.fixture
def written(monkeypatch):
    names, stored = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: names.append(name) or stored(df, name))
    return names


@pytest.mark.parametrize("seed", [1, 2])
def test_links_join_known_components(spark, seed):
    """Links in three goes give what all of them give at once: loops, repeats, new nodes, negative ids."""
    draw = np.random.default_rng(seed)
    links = [tuple(x) for x in draw.integers(-60, 60, (75, 2)).tolist()] + [(5, 5), (7, 8), (8, 7), (200, 201)]
    goes = [links[:40], links[40:41] + links[30:40], links[41:]]
    known = None
    for k, some in enumerate(goes):
        known = graph.components(frame(spark, some), known)
        assert as_dict(known) == roots_of(sum(goes[: k + 1], []))
    assert as_dict(graph.components(frame(spark, links))) == roots_of(links)
    assert as_dict(graph.components(frame(spark, []), known)) == roots_of(links)
    assert as_dict(graph.components(frame(spark, []))) == {}


def test_long_chain(spark):
    links = [(k, k + 1) for k in range(40)]
    assert as_dict(graph.components(frame(spark, links))) == dict.fromkeys(range(41), 0)


def test_stars_take_no_step(spark, written):
    """What is settled is not gone over again, nor are the links of known components."""
    known = graph.components(frame(spark, [(1, k) for k in range(2, 30)] + [(40, 41)]))
    assert as_dict(known) == {**dict.fromkeys(range(1, 30), 1), 40: 40, 41: 40}
    assert written == ["links", "known"]
    joined = graph.components(frame(spark, [(17, 41), (17, 40), (3, 4)]), known)
    assert as_dict(joined) == dict.fromkeys([*range(1, 30), 40, 41], 1)
    assert written == ["links", "known"] * 2


def test_few_links_take_few_tasks(spark):
    """Whatever the number of shuffle partitions is."""
    conf = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        edges = frame(spark, [(k, k + 1) for k in range(20)])
        for step in (graph._large_star, graph._small_star):
            assert step(edges, 6).rdd.getNumPartitions() == 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
