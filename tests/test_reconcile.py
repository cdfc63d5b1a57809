"""Reconciliation on repeated tx ids against a simulation by the clock."""

import random

from tidemark.operators import joins
from tidemark.operators import sequence as seq


def simulate(pays, receipts, pay_wait=5, receipt_wait=3):
    """Events in time order; each side queues until the other comes or its wait ends."""
    events = sorted([(t, 0, o) for t, o in pays] + [(t, 1, c) for t, c in receipts], key=lambda e: (e[0], e[1], e[2]))
    waiting, out = {0: [], 1: []}, []
    for t, side, who in events:
        for s, wait in ((0, pay_wait), (1, receipt_wait)):
            while waiting[s] and waiting[s][0][0] + wait < t:
                x = waiting[s].pop(0)
                out.append((x, None) if s == 0 else (None, x))
        if waiting[1 - side]:
            x = waiting[1 - side].pop(0)
            out.append(((t, who), x) if side == 0 else (x, (t, who)))
        else:
            waiting[side].append((t, who))
    return out + [(x, None) for x in waiting[0]] + [(None, x) for x in waiting[1]]


def test_orphans_do_not_shift_later_pairs(spark):
    pays = spark.createDataFrame([(1, "a", 0), (2, "a", 100)], "order_id long, tx_id string, timestamp long")
    receipts = spark.createDataFrame([("a", "x", 101)], "tx_id string, pay_channel string, timestamp long")
    got = {(r["tag"], r["pay_time"], r["receipt_time"]) for r in joins.reconcile(pays, receipts).collect()}
    assert got == {("matched-pays", 100, 101), ("unmatched-pays", 0, None)}


def test_random_repeated_ids(spark):
    rng = random.Random(12)
    pays, receipts, n = [], [], 0
    for tx in range(40):
        for _ in range(rng.randrange(0, 9)):
            n += 1
            pays.append((n, f"t{tx}", rng.randrange(0, rng.choice([12, 60, 9000]))))
        for _ in range(rng.randrange(0, 9)):
            receipts.append((f"t{tx}", rng.choice("xy"), rng.randrange(0, rng.choice([12, 60, 9000]))))
    want = []
    for tx in range(40):
        p = [(t, o) for o, x, t in pays if x == f"t{tx}"]
        r = [(t, c) for x, c, t in receipts if x == f"t{tx}"]
        want += [(a and a[0], b and b[0], f"t{tx}") for a, b in simulate(p, r)]
    got = joins.reconcile(spark.createDataFrame(pays, "order_id long, tx_id string, timestamp long"),
                          spark.createDataFrame(receipts, "tx_id string, pay_channel string, timestamp long"))
    found = got.collect()
    assert sorted(((r["pay_time"], r["receipt_time"], r["tx_id"]) for r in found), key=repr) == sorted(want, key=repr)
    assert sorted(r["order_id"] for r in found if r["order_id"] is not None) == list(range(1, n + 1))
    chunked = joins.reconcile(spark.createDataFrame(pays, "order_id long, tx_id string, timestamp long"),
                              spark.createDataFrame(receipts, "tx_id string, pay_channel string, timestamp long"),
                              chunking="time", rows_per_chunk=3)
    assert sorted(map(repr, map(tuple, chunked.collect()))) == sorted(map(repr, map(tuple, found)))


def test_one_tx_id_that_never_pauses(spark):
    """Thousands of rows of a single tx id without a gap: no Python, and no task with all of them."""
    rng = random.Random(4)
    pays = [(i, None, rng.randrange(4000)) for i in range(3000)]
    receipts = [(None, "x", rng.randrange(4000)) for _ in range(2500)]
    p = spark.createDataFrame(pays, "order_id long, tx_id string, timestamp long")
    r = spark.createDataFrame(receipts, "tx_id string, pay_channel string, timestamp long")
    out = joins.reconcile(p, r, rows_per_chunk=500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    want = [(a and a[0], b and b[0]) for a, b in simulate([(t, i) for i, _, t in pays], [(t, c) for _, c, t in receipts])]
    assert sorted(((x["pay_time"], x["receipt_time"]) for x in out.collect()), key=repr) == sorted(want, key=repr)


def test_running_clamp_over_levels(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for key, n in (("a", 700), (None, 30), ("b", 1)):
        y = 5
        for i in range(1, n + 1):
            low, high = rng.randrange(-9, 20), rng.randrange(-9, 20)     # they may cross
            want[key, i] = y
            rows.append((key, i, low, high))
            y = min(high, max(low, y))
    df = spark.createDataFrame(rows, "k string, i long, lo long, hi long")
    for block in (4, 64, 1024):
        got = seq.running_clamp(df, ["k"], "i", "lo", "hi", "y", start=5, block=block)
        assert {(r["k"], r["i"]): r["y"] for r in got.collect()} == want


def test_walk_equals_simulation():
    rng = random.Random(1)
    for _ in range(300):
        p = sorted((rng.randrange(30), i) for i in range(rng.randrange(8)))
        r = sorted((rng.randrange(30), i) for i in range(rng.randrange(8)))
        assert sorted(joins.pair_waiting(p, r, 5, 3), key=repr) == sorted(simulate(p, r), key=repr)
