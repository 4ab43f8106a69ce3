"""Quality cascade and curriculum mix against plain Python."""
import hashlib
import random
import re

import pytest

from feedlens.llm import mixing as M
from feedlens.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(t):
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    where = {}
    for i in range(len(w) - 2):
        where.setdefault(tuple(w[i:i + 3]), []).append(i)
    again = {i + j for v in where.values() if len(v) > 1 for i in v for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


def prose(rng, n):
    return " ".join(rng.choice(["river", "stone", "über", "walk", "año", "green", "x1", "a,", "to", "of"]) + str(rng.randrange(50)) * (rng.random() < .2)
                    for _ in range(n))


def rows():
    rng = random.Random(6)
    out = [(1, None), (2, ""), (3, " \n\t"), (4, "w " * 60), (5, "\n".join(["same line here"] * 30)), (6, "a\x1cb c\x85d"),
           (7, "# $ % " * 40 + prose(rng, 60)), (8, prose(rng, 49)), (9, "x " * 49 + "x"), (9, "x " * 49 + "x"), (None, prose(rng, 80))]
    return out + [(100 + i, prose(rng, rng.randint(1, 300)).replace(" to", "\n")) for i in range(80)]


def frame(spark, rs):
    return spark.createDataFrame([(d, t, 1, True, "m") for d, t in rs], "doc_id long, text string, n_words int, kept boolean, size string")


def test_counts_and_base_rules(spark):
    rs = rows()
    got = sorted((tuple(r)[:7] for r in Q.quality_cascade(frame(spark, rs)).collect()), key=repr)
    want = []
    for d, t in rs:
        c = counts(t or "")
        want.append((d, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want, key=repr)


def test_verdict_does_not_depend_on_the_order(spark):
    rs = rows()
    for order in (list(Q.RULES), list(Q.RULES)[::-1]):
        pages = {d: Q.Page((t or "").encode()) for d, t in rs}
        kept = {d for d, p in pages.items() if not any(Q.RULES[n](p) for n in order)}
        assert {r.doc_id for r in Q.quality_cascade(frame(spark, rs)).collect() if r.kept} == kept
    stay = Q.keep_good(frame(spark, rs))
    assert {r.doc_id for r in stay.collect()} == kept and stay.columns == ["doc_id", "text", "n_words", "kept", "size"]
    assert 7 not in kept and None in kept


def test_rules_run_by_rejection_per_cost():
    def slow(p):
        sum(range(20000))
        return True
    texts = [b"some words here"] * 50
    assert Q.order_rules(texts, {"slow": slow, "never": lambda p: False, "cheap": lambda p: True})[0] == "cheap"
    assert Q.order_rules([], {"b": slow, "a": slow}) == ["b", "a"]


def test_later_rules_are_measured_on_what_is_left():
    # "same" rejects just what "first" rejects, at a little more cost: behind it, it is the worst of all
    texts = [b"a"] * 90 + [b"b"] * 10
    rules = {"first": lambda p: p.raw == b"a", "same": lambda p: sum(range(50)) and p.raw == b"a", "other": lambda p: sum(range(200)) and p.raw == b"b"}
    assert Q.order_rules(texts, rules) == ["first", "other", "same"]


def test_sample_is_drawn_from_the_whole_table(spark):
    df = spark.range(0, 40_000, 1, 8).selectExpr("id", "cast(id as string) AS text")
    got = [int(t) for t in Q.sample_texts(df, "text")]
    assert 250 < len(got) < 600 and min(got) < 4000 and max(got) > 36_000
    assert len(Q.sample_texts(df.limit(7), "text")) == 7


def test_all_rows_rejected(spark):
    rs = [(1, None), (2, "few words"), (3, "same " * 200)]
    assert Q.keep_good(frame(spark, rs)).collect() == []
    assert not any(r.kept for r in Q.quality_cascade(frame(spark, rs)).collect())


def test_empty_quality(spark):
    assert Q.quality_cascade(frame(spark, [])).count() == 0 and Q.keep_good(frame(spark, [])).count() == 0


def mixed(spark, rs):
    return spark.createDataFrame([(d, t, s, 1, "b") for d, t, s in rs], "doc_id long, text string, source string, size int, bucket string")


def mix_brute(rs):
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({s for _, _, s in rs}, key=lambda s: (s is None, s.encode() if s is not None else b""))
    total = {s: sum(size(t) for _, t, x in rs if x == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    budget, target, open_ = 1.5 * sum(total.values()), {}, set(sources)
    while open_:  # share by weight, stop those above, share again
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * total[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * total[s] for s in full}
        open_ -= full
    out = []
    for s in sources:
        at = 0
        key = lambda r: (hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest(), r[0] is not None, r[0] or 0, size(r[1]))
        for d, t, _ in sorted((r for r in rs if r[2] == s), key=key):
            n = size(t)
            copies = sum(at + p * total[s] + n / 2 <= target[s] + 1e-9 for p in range(2)) if n else 0
            out.append((d, n, total[s], round(target[s], 6), copies * n))
            at += n
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_equals_plain_python(spark, seed):
    rng = random.Random(seed)
    names = ["src0", "src1", "ä", "Z", "", None, "src10"]
    rs = [(i, prose(rng, rng.randint(0, 60)), "src0" if rng.random() < .4 else rng.choice(names)) for i in range(300)]
    rs += [(5, "a b", "src0"), (5, "a b", "src0"), (None, "x y z", "Z"), (301, None, "Z"), (302, "", None), (303, "w " * 900, "src1")]
    p = M.plan(mixed(spark, rs))
    got = sorted(((r.id, r.size, r.source_size, round(r.target, 6), r.taken) for r in p.collect()), key=repr)
    assert got == mix_brute(rs)


def test_mix_rows_follow_the_schedule(spark):
    rng = random.Random(8)
    rs = [(i, prose(rng, 20), f"s{i % 3}") for i in range(600)]
    out = M.mix(mixed(spark, rs))
    assert out.columns == ["doc_id", "text", "source", "size", "bucket"]
    order = [r.source for r in out.collect()]
    taken = {r.id: r.taken // r.size for r in M.plan(mixed(spark, rs)).collect()}
    assert len(order) == sum(taken.values())
    third = len(order) // 3
    share = lambda part, s: sum(x == s for x in part) / order.count(s)
    assert share(order[:third], "s0") > share(order[-third:], "s0")   # fades out
    assert share(order[:third], "s2") < share(order[-third:], "s2")   # comes in


def test_schedules_invert(spark):
    df = spark.range(0, 101).selectExpr("id / 100.0D AS u")
    for knots in (*M.SCHEDULES, ((0, 0), (1, 2)), ((0, 1), (0.3, 0), (0.6, 0), (1, 1))):
        area = sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
        for r in df.select("u", M.invert_schedule(df["u"], knots).alias("t")).collect():
            spent = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                x = min(max(r.t - t0, 0), t1 - t0)
                spent += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            assert abs(spent / area - r.u) < 1e-9, (knots, r)


def test_empty_mix_runs_no_python(spark):
    assert M.plan(mixed(spark, [])).count() == 0 and M.mix(mixed(spark, [])).count() == 0
    plan = M.mix(mixed(spark, [(1, "a b", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
