"""Components of links that lie across tasks, and the jobs that they take."""

from __future__ import annotations

import random

from opinarium.llm import components


def test_links_across_tasks(spark, monkeypatch):
    """Chains, a hub, a ring, repeats and loops, dealt over many tasks and cut into small lots."""
    monkeypatch.setattr(components, "LINKS_AT_ONCE", 3)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(205, 201), (201, 203), (203, 205)]
    links += [(300, 300)] + links[:10]
    random.Random(7).shuffle(links)
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(12)).collect()
    wanted = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)} | {203: 201, 205: 201}
    assert sorted((r["node"], r["root"]) for r in found) == sorted(wanted.items())


def test_stars_take_no_round(spark, monkeypatch):
    """Links that are stars around the smallest node already, some of them twice, are only written."""
    rounds = []
    star = components._large_star
    monkeypatch.setattr(components, "_large_star", lambda edges: rounds.append(1) or star(edges))
    links = spark.createDataFrame([(b"a", b"a" + bytes([i])) for i in range(100)] * 2, "a binary, b binary")
    found = components.components(links.repartition(4)).collect()
    assert len(found) == 100 and {bytes(r["root"]) for r in found} == {b"a"} and not rounds
