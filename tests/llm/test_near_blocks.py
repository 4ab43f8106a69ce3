"""Members of a large list move a bounded number of times."""
import random

from pyspark.sql import functions as F

from feedlens.llm import near_dedup as N

from .test_near_dedup import brute, run


def near_copies(n, words):
    rng = random.Random(7)
    pool = [f"q{i}" for i in range(3000)]
    core, rows = [rng.choice(pool) for _ in range(words)], []
    for i in range(n):  # few of them are linked to each other
        w = list(core)
        for _ in range(rng.randint(2, 4)):
            w[rng.randrange(words)] = rng.choice(pool)
        rows.append((i, " ".join(w)))
    return rows


def test_copies_of_members_do_not_grow_with_the_list(spark, monkeypatch):
    made, written = [], N.written

    def seen(df, name):
        out = written(df, name)
        if name == "block-members":
            made.append(out.count())
        return out
    monkeypatch.setattr(N, "written", seen)
    monkeypatch.setattr(N, "HUBS", (1,))
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "SHARES", 2, raising=False)
    rows = near_copies(240, 50)
    assert run(spark, rows) == brute(rows)
    classes = len({t for _, t in rows})
    # at most twice on either side, in each list that is left
    assert made and max(made) <= 4 * classes * (N.COORDINATES - N.MATCHES + 1) // 4


def test_long_texts_make_smaller_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "HUBS", (1,))
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "MOST_WORDS", 400, raising=False)
    rows = near_copies(80, 60)
    assert run(spark, rows) == brute(rows)


def test_members_of_a_large_list_meet_few_hubs(spark, monkeypatch):
    made, written = [], N.written

    def seen(df, name):
        out = written(df, name)
        if name == "hub-pairs":
            made.append(out.count())
        return out
    monkeypatch.setattr(N, "written", seen)
    monkeypatch.setattr(N, "HUBS", (16,))
    monkeypatch.setattr(N, "MEETS", 3, raising=False)
    rows = near_copies(240, 50)
    assert run(spark, rows) == brute(rows)
    classes = len({t for _, t in rows})
    # beside those of small lists, which are met in full
    assert made and made[0] <= 20 * classes


def test_all_pairs_of_a_small_list_are_met(spark, monkeypatch):
    monkeypatch.setattr(N, "HUBS", (16,))
    monkeypatch.setattr(N, "HUBS_OF_LARGE", 1, raising=False)
    monkeypatch.setattr(N, "MEETS", 1, raising=False)
    monkeypatch.setattr(N, "block_links", lambda members, lists, nodes, texts: members.select(F.col("num").alias("a"), F.col("num").alias("b")).limit(0))
    rows = near_copies(17, 60)
    assert run(spark, rows) == brute(rows)
