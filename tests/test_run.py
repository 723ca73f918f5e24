"""A whole run against a plain loop."""

import hashlib

from gleanery.plans import QUERIES

from .test_matching import set_ratio

DATA = "/root/testdata/sf0.001"


def test_a_run_groups_and_gates_its_listings(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").selectExpr("o_orderkey k", "o_custkey c", "date_trunc('month', o_orderdate) d", "o_orderstatus s").collect()
    names = {r.p_partkey: r.p_name for r in spark.read.parquet(f"{DATA}/part.parquet").collect()}
    tier = {0: 0, 1: 1, 2: 1, 3: 2, 4: 2}
    listed = []
    for o in orders:
        title = names.get(o.k % 200 + 1)
        if title:
            n = o.c % 5
            i = hashlib.sha1(f"s{n}|{o.k}".encode()).hexdigest()[:16]
            listed.append(((tier[n], n != 1, f"s{n}"), i, title, (o.d, o.c % 10), n, o))
    leaders: dict = {}
    groups: dict = {}
    for r in sorted(listed, key=lambda r: (r[0], r[1])):
        scored = [(set_ratio(r[2], o[2]), o) for o in leaders.setdefault(r[3], [])]
        top = max(scored, key=lambda x: x[0], default=(0, None))
        if top[0] >= 82:
            groups[top[1][1]].append(r)
        else:
            leaders[r[3]].append(r)
            groups[r[1]] = [r]
    got = {r.id: r for r in QUERIES["process_run"](spark, DATA).collect()}
    assert set(got) == set(groups) and len(groups) < len(listed)
    for i, g in groups.items():
        r, best = got[i], g[0]
        assert r.title == best[2] and r.independent_source_count == len({x[4] for x in g}) and r.curation_score == len({x[4] for x in g if x[4] == 1})
        unknown = best[3][1] == 9 and not all(x[4] == 4 for x in g)
        assert r.venue_unknown == unknown and r.source_underdelivered == all(x[4] == 3 for x in g) and r.tier_c_only == all(x[4] > 2 for x in g)
        assert r.status == ("cancelled" if best[5].s == "P" else "active")
        if r.publish_state == "published":
            assert not (unknown or r.source_underdelivered or r.status == "cancelled")
    series: dict = {}
    for i in groups:
        series.setdefault(got[i].series, set()).add(got[i].venue_key)
    assert all(len(v) == 1 for v in series.values()) and set(series) <= set(groups)
