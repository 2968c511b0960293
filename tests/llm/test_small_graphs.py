"""Few edges are settled on the driver, in a few jobs, as the joins would settle them."""

import random

import pytest

from martforge.llm import graph


def edges(kind):
    draw = random.Random(7)
    if kind == "path":  # the longest way to the smallest node
        nodes = [draw.randrange(-(1 << 62), 1 << 62) for _ in range(300)]
        return list(zip(nodes, nodes[1:]))
    if kind == "star":  # around its largest node
        return [(1000, i) for i in range(200)]
    if kind == "odd":
        return [(1, 1), (None, 2), (3, None), (4, 5), (5, 4), (4, 5), (-(1 << 63), (1 << 63) - 1)]
    return [(draw.randrange(400), draw.randrange(400)) for _ in range(300)]


def found(frame):
    assert frame.dtypes == [("node", "bigint"), ("component", "bigint")]
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("kind", ["path", "star", "odd", "random"])
def test_same_as_by_joins(spark, monkeypatch, kind):
    links = spark.createDataFrame(edges(kind), "a long, b long")
    here = found(graph.connected_components(links))
    monkeypatch.setattr(graph, "DRIVER_EDGES", 0)
    assert here == found(graph.connected_components(links)) and here


def test_few_jobs(spark):
    links = spark.createDataFrame(edges("path"), "a long, b long")
    spark.sparkContext.setJobGroup("few-edges", "few edges")
    try:
        graph.connected_components(links)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few-edges")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 10  # by joins: three or more in each of some ten rounds


@pytest.mark.parametrize("few", [0, 500_000])
def test_more_links_join_known_components(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "DRIVER_EDGES", few)
    all_links = edges("random") + [(500, 501)]
    known = None
    for part in (all_links[:100], all_links[100:250], [], all_links[250:]):
        known = graph.more_components(spark.createDataFrame(part, "a long, b long"), known)
    assert found(known) == found(graph.connected_components(spark.createDataFrame(all_links, "a long, b long")))
