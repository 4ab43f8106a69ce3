"""op3 deals: its digest comes from the positioned, range-sorted copies."""
import math
import random

import pytest
from pyspark.sql import functions as F

from feedlens.llm import mixing as M
from feedlens.llm import queries as Q

from .test_quality_and_mix import mix_brute, mixed, prose


def spent(knots, t):
    """Integral of the schedule up to ``t``."""
    out = 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        x = min(max(t - t0, 0), t1 - t0)
        out += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
    return out


def test_order_holds_the_positions_of_all_copies(spark):
    rng = random.Random(5)
    rs = [(i, prose(rng, rng.randint(0, 40)), rng.choice(["a", "b", "c", None])) for i in range(200)]
    rs += [(5, "a b", "a"), (None, "x y z", "c"), (301, None, "b")]
    docs, order = M.dealt(mixed(spark, rs))
    got = sorted(((r.id, r.size, r.source_size, round(r.target, 6), r.taken) for r in docs.collect()), key=repr)
    assert got == mix_brute(rs)
    rows = order.collect()
    words = sum(x[1] for x in got)
    assert sum(r.size for r in rows) == sum(x[4] for x in got)
    assert all(0 <= r.position <= 1.5 * words for r in rows)
    # written in range-sorted parts: sorted inside each, and the parts don't overlap
    parts = {}
    for r in order.select("position", F.input_file_name().alias("f")).collect():
        parts.setdefault(r.f, []).append(r.position)
    ps = sorted(parts.values(), key=lambda x: x[0])
    assert all(x == sorted(x) for x in ps) and all(x[-1] <= y[0] for x, y in zip(ps, ps[1:]))
    # the place of each copy in its source is what its schedule has spent at its position
    names = {"0a": 0, "0b": 1, "0c": 2, "1": 3}
    at = {r.rid: names[r.skey] for r in docs.sparkSession.read.parquet(_plan_of(order)).collect()}
    target = {names[r.skey]: r.target for r in docs.collect()}
    for k in range(4):
        mine = sorted((r for r in rows if at[r.rid] == k), key=lambda r: r.position)
        before = 0
        for r in mine:
            middle = spent(M.SCHEDULES[k % 3], r.position / (1.5 * words)) * target[k]
            assert math.isclose(middle, before + r.size / 2, rel_tol=1e-6, abs_tol=1e-6)
            before += r.size


def _plan_of(order):
    """The folder of the plan written just before the order."""
    import glob
    import os
    path = order.inputFiles()[0].split("://")[-1].rsplit("/", 1)[0]
    return "file://" + max(glob.glob(os.path.join(os.path.dirname(path), "*mix-plan*")), key=os.path.getmtime)


def test_op3_inverts_the_schedules(spark, monkeypatch):
    monkeypatch.setattr(M, "invert_schedule", lambda u, knots: F.raise_error(F.lit("inverted")).cast("double"))
    with pytest.raises(Exception, match="inverted"):
        Q.QUERIES["op3_curriculum_mix"](spark, "/root/testdata/sf0.001").collect()
