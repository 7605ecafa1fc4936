"""Walks that run until nothing moves."""

from corpusmap.llm import urls


def test_walks_reach_far_hosts(spark):
    """Hosts 30 links away get trust, and a cycle ends at the values of the whole series."""
    links = [(f"h{i}", f"h{i + 1}", 1) for i in range(30)] + [("h30", "h29", 1)]
    seeds = spark.createDataFrame([("h0", 1.0, 0.0), ("h30", 0.0, 1.0)], "host string, trusted double, blocked double")
    got = {r.host: r for r in urls.spread(spark.createDataFrame(links, "a string, b string, n bigint"), seeds, 1e-4).collect()}
    want = {f"h{i}": 0.15 * 0.85**i for i in range(29)}
    want["h29"] = 0.15 * 0.85**29 / (1 - 0.85**2)
    want["h30"] = 0.85 * want["h29"]
    got = {h: r.trust for h, r in got.items()}
    assert set(got) == set(want) and sum(abs(got[h] - want[h]) for h in want) <= 1e-4
