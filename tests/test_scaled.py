"""Chunked terms, streams over folders, workbooks of bounded size: small cases against brute force."""
import math
import os
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from feedlens.operators import embed as EM
from feedlens.operators import topics as TP
from feedlens.sources import workbooks as WB


def test_stream_over_a_folder_of_files(spark, tmp_path):
    from feedlens.plans import catalog as C
    words = "alpha beta gamma delta epsilon zeta".split()
    docs = [(i, " ".join(random.Random(i).choices(words, k=60)), ["en", "fr"][i % 2], "src1", 300) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(i, 0, "user", " ".join(random.Random(i).choices(words, k=9))) for i in range(10)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, C.q_assign_stream(spark, str(tmp_path)).collect()))
    assert got == sorted(map(tuple, C.q_assign_topics(spark, str(tmp_path)).collect())) and len(got) == 10


ROWS = [(1, 0, "red blue blue sun"), (2, 0, "red red moon"), (3, 1, "blue moon moon star"), (4, None, "red star"), (5, 1, ""),
        (6, 1, None), (7, 0, "sun"), (7, 0, "sun moon"), (None, 1, "star blue")]


def test_terms_are_one_row_a_document_and_one_a_word_of_a_chunk(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, topic int, clean string").coalesce(1)
    t = TP.topic_terms(docs)
    want = {}
    for i, topic, text in ROWS:
        want.setdefault((i, topic), Counter()).update(re.findall(r"\w\w+", text or ""))
    name = {(r.chunk, r.code): r.word for r in t.words.collect()}
    got = {(r.doc_id, r.topic): {name[r.chunk, c]: n for c, n in zip(r.codes, r.tf)} for r in t.rows.collect()}
    assert got == {k: dict(v) for k, v in want.items()}
    by = Counter()
    for (_, topic), n in want.items():
        for w, x in n.items():
            by[topic, w] += x
    assert {(r.topic, r.word): r.n for r in TP.term_counts_from(t).collect()} == dict(by)
    assert t.words.groupBy("chunk", "topic", "word").count().where("count > 1").isEmpty()


def test_representative_docs_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, i % 3, " ".join(rng.choices(["w%02d" % k for k in range(30)], k=rng.randint(1, 25)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, topic int, clean string").repartition(4)
    tc = TP.term_counts(docs)
    idf, scores = TP.idf_table(tc), TP.ctfidf(tc)
    weight = {(r.topic, r.word): r.score for r in scores.collect()}
    rare = {r.word: r.idf for r in idf.collect()}
    norm = {t: math.sqrt(sum(v * v for (a, _), v in weight.items() if a == t)) for t in range(3)}
    sim = {}
    for i, t, text in rows:
        n = Counter(text.split())
        wd = {w: c / sum(n.values()) * rare[w] for w, c in n.items()}
        sim[i] = sum(x * weight[t, w] for w, x in wd.items()) / math.sqrt(sum(x * x for x in wd.values())) / norm[t]
    got = TP.representative_docs(docs, scores, idf, 4).collect()
    for t in range(3):
        best = sorted((i for i, u, _ in rows if u == t), key=lambda i: (-round(sim[i], 9), i))[:4]
        assert [r.doc_id for r in sorted((r for r in got if r.topic == t), key=lambda r: r.rank)] == best
    assert all(math.isclose(r.similarity, sim[r.doc_id], abs_tol=1e-12) for r in got)


def test_hashed_vectors_and_random_index_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(i, x) for i, _, x in ROWS], "doc_id long, clean string")
    vecs = {r.doc_id: r.vec for r in EM.encode_hashed(docs, 16).collect()}
    assert set(vecs) == {1, 2, 3, 4, 5, 6, 7, None} and vecs[5] == vecs[6] == [0.0] * 16
    assert math.isclose(sum(x * x for x in vecs[7]), 1.0)
    doc, word = EM.random_index(docs, 8, 2)
    assert {r.word for r in word.collect()} == {"red", "blue", "sun", "moon", "star"}
    got = {r.doc_id: r.vec for r in doc.collect()}
    w = {r.word: r.vec for r in word.collect()}
    assert got[2] == [(2 * a + b) / 3 for a, b in zip(w["red"], w["moon"])] and got[None] == [0.0] * 8


def test_workbooks_hold_a_bounded_number_of_characters(spark, tmp_path):
    df = spark.range(0, 30, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1_000_000).alias("text"))
    WB.write_feedback_workbooks(df, f"{tmp_path}/wb")
    assert len([n for n in os.listdir(f"{tmp_path}/wb") if n.endswith(".xlsx")]) == 4
    back = WB.read_feedback_workbooks(spark, f"{tmp_path}/wb/*.xlsx", "text", id_column="doc_id")
    assert back.where(F.length("text") == 1_000_000).count() == 30


def test_density_clusters_over_many_blocks_against_brute_force(spark):
    from feedlens.operators import cluster as CL
    rng = random.Random(9)
    pts = [(round(rng.uniform(0, 60), 3), round(rng.uniform(0, 60), 3)) for _ in range(500)]
    pts += [(10.0, 10.0)] * 5000 + [(100 + 0.5 * i, 0.0) for i in range(40)]
    eps, size = 1.5, 4
    uniq = sorted(set(pts))
    n = Counter(pts)
    near = {p: [q for q in uniq if math.dist(p, q) <= eps] for p in uniq}
    core = {p for p in uniq if sum(n[q] for q in near[p]) - 1 >= 3}
    ids = {}
    for i, p in enumerate(pts):
        ids.setdefault(p, []).append(i)
    want, seen = {i: -1 for i in range(len(pts))}, set()
    for p in sorted(core):
        if p in seen:
            continue
        todo, part = [p], {p}
        while todo:
            for q in near[todo.pop()]:
                if q in core and q not in part:
                    part.add(q)
                    todo.append(q)
        seen |= part
        members = [i for q in part for i in ids[q]]
        if len(members) >= size:
            want.update(dict.fromkeys(members, min(members)))
    df = spark.createDataFrame([(i, list(p)) for i, p in enumerate(pts)], "doc_id long, vec array<double>")
    assert {r.doc_id: r.cluster for r in CL.density_cluster_at(df, eps, 2, 3, size).collect()} == want


def test_pairs_of_blocks_are_not_shuffled(spark):
    from feedlens.operators import neighbors as NB
    df = spark.range(0, 9000).select(F.col("id").alias("doc_id"), F.array(F.lit(1.0), F.col("id") / 9000.0).alias("vec"))
    p = NB._prepare(df, "doc_id", "vec", "euclidean", 2, 2, 7)
    near = NB.nearest(p, 2, 2)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "FlatMapCoGroups" not in plan
    got = {(r.src, r.rank): r.dst for r in near.collect()}
    assert len(got) == 18000 and got[500, 1] in (499, 501) and got[0, 1] == 1 and got[0, 2] == 2
