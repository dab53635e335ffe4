"""Random change logs: the Spark job against a brute-force model written from the
definitions (FIXTURES.md), plus invariants."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assetlens.plans.batch import compute_assets

TABLES = ["t0", "t1", "t2", "t3"]
OPS = ["create", "update", "delete"]
GOOD = ['(a,add,5,"x")', '(b,add,7,"x,y")', '(c,del,11,"x")']
BAD = "(d,add,3,x)"


@st.composite
def change_logs(draw):
    n_ti = draw(st.integers(1, 8))
    n_p = draw(st.integers(0, 10))
    n_c = draw(st.integers(0, 8))
    seqs = draw(st.permutations(list(range(n_ti + n_p + n_c))))
    ti = [(draw(st.sampled_from(TABLES)), "name", draw(st.sampled_from(["n0", "n1", "n2"])),
           draw(st.sampled_from(["d0", "d1"])), draw(st.sampled_from(["u0", "u1"])),
           draw(st.sampled_from(OPS)), seqs[i]) for i in range(n_ti)]
    parts = [(draw(st.sampled_from(TABLES)), draw(st.sampled_from(["p0", "p1", None])),
              draw(st.sampled_from(OPS)), seqs[n_ti + i]) for i in range(n_p)]
    commits = [(draw(st.sampled_from(TABLES)), f"c{i}",
                draw(st.lists(st.sampled_from(GOOD + [BAD]), max_size=3)),
                draw(st.booleans()), draw(st.sampled_from(OPS)), seqs[n_ti + n_p + i])
               for i in range(n_c)]
    return ti, parts, commits


def model(ti, parts, commits):
    """Direct definitions, one dictionary per measure."""
    last = lambda rows: max(rows, key=lambda r: r[-1])
    by_table = defaultdict(list)
    for r in ti:
        by_table[r[0]].append(r)
    latest = {}
    for t, rows in by_table.items():
        live = [r for r in rows if r[5] != "delete"]
        a = last(live) if live else (t, None, None, None, None, None, None)
        latest[t] = {"namespace": a[2], "domain": a[3], "creator": a[4], "op": last(rows)[5]}
    pl = defaultdict(list)
    for t, d, op, s in parts:
        if d is not None:
            pl[(t, d)].append((op, s))
    pc = defaultdict(int)
    for (t, _), rows in pl.items():
        pc[t] += 0 if max(rows, key=lambda r: r[1])[0] == "delete" else 1
    dc = {}
    for t, _, ops, committed, op, _ in commits:
        if any(o == BAD for o in ops):
            continue
        adds = [int(o.split(",")[2]) for o in ops if ",add," in o]
        if op == "delete":
            sign = -1
        elif committed:
            sign = 1
        else:
            continue
        f, b = dc.get(t, (0, 0))
        dc[t] = (f + sign * len(adds), b + sign * sum(adds))
    assets = {t: {**latest[t], "partition_counts": pc[t], "file_counts": dc[t][0],
                  "file_total_size": dc[t][1]}
              for t in latest if t in pc and t in dc}
    hist = {t: {(r[2], r[3], r[4]) for r in by_table[t] if r[5] != "delete"} for t in assets}

    def rollup(key, idx):
        out = {}
        keys = {g[idx] for h in hist.values() for g in h}
        for k in keys:
            live = [a for a in assets.values() if a["op"] != "delete" and a[key] == k]
            out[k] = (len(live), sum(a["partition_counts"] for a in live),
                      sum(a["file_counts"] for a in live), sum(a["file_total_size"] for a in live))
        return out

    users = {}
    for u, m in rollup("creator", 2).items():
        hs = [g for h in hist.values() for g in h if g[2] == u]
        users[u] = (len({g[1] for g in hs}), len({g[0] for g in hs})) + m
    return assets, rollup("namespace", 0), rollup("domain", 1), users


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(change_logs())
def test_batch_job_equals_model(spark, logs, data):
    ti, parts, commits = data
    r = compute_assets(logs.table_info(ti), logs.partitions(parts), logs.commits(commits),
                       keep=False)
    assets, ns, dom, users = model(ti, parts, commits)
    got = {row["table_id"]: row.asDict() for row in r.table_assets.collect()}
    assert set(got) == set(assets)
    for t, a in assets.items():
        for k, v in a.items():
            assert got[t][k] == v, (t, k)
    m = ("table_counts", "partition_counts", "file_counts", "file_total_size")
    assert {x["namespace"]: tuple(x[c] for c in m) for x in r.namespace_assets.collect()} == ns
    assert {x["domain"]: tuple(x[c] for c in m) for x in r.domain_assets.collect()} == dom
    assert {x["creator"]: (x["domain_counts"], x["namespace_counts"]) + tuple(x[c] for c in m)
            for x in r.user_assets.collect()} == users
    # Invariant: the namespace table counts add up to the live complete tables.
    assert sum(v[0] for v in ns.values()) == sum(1 for a in assets.values() if a["op"] != "delete")
