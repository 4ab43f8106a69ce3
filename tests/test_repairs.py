"""Ids of any size, bounds that raise, sources by suffix, neighbours in blocks."""
import math
import random

import pytest
from pyspark.sql import functions as F

from feedlens.operators import cluster as CL
from feedlens.operators import neighbors as NB
from feedlens.sources import feedback as FB
from feedlens.sources import sinks as SK
from feedlens.sources import workbooks as WB


def _blobs(n=75, seed=3):
    rng = random.Random(seed)
    centres = [(0, 0), (4, 0), (0, 5)]
    return [[c + rng.gauss(0, 0.3) for c in centres[i % 3]] for i in range(n)]


@pytest.mark.parametrize("first", [2**55, -40, 2**61])
def test_hierarchy_has_a_row_per_point_for_any_id(spark, first):
    points = _blobs()

    def run(start):
        df = spark.createDataFrame([(start + i, p) for i, p in enumerate(points)], "doc_id long, vec array<double>")
        got = CL.density_cluster_tree(df, 5, 3).collect()
        assert len(got) == len(points)
        return sorted((r.doc_id - start, r.cluster - start if r.cluster != -1 else None) for r in got)
    assert run(first) == run(0)


def test_unfinished_rounds_raise(spark):
    path = spark.range(0, 40).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    with pytest.raises(RuntimeError):
        CL.connected_components(spark.range(0, 41), path, max_rounds=1)
    assert {r.component for r in CL.connected_components(spark.range(0, 41), path).collect()} == {0}


def test_sources_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(7)], "doc_id long, text string")
    SK.write_feedback_csv(df, str(tmp_path / "a.csv"))
    df.write.parquet(str(tmp_path / "b.parquet"))
    WB.write_feedback_workbooks(df, str(tmp_path / "book"))
    for path in (str(tmp_path / "a.csv"), str(tmp_path / "b.parquet"), str(tmp_path / "book" / "*.xlsx")):
        got = FB.load_feedback(spark, path, "text", "doc_id")
        assert sorted((r.doc_id, r.text) for r in got.collect()) == [(i, f"text {i}") for i in range(7)]
    with pytest.raises(ValueError):
        FB.load_feedback(spark, str(tmp_path / "a.txt"), "text")
    with pytest.raises(FileNotFoundError):
        FB.load_feedback(spark, str(tmp_path / "none.csv"), "text")


def test_snapshot_lists_topics_by_size(spark, tmp_path):
    report = spark.createDataFrame([(t, n, "k", "s", "x", "p", ["d"]) for t, n in [(3, 5), (1, 9), (2, 5)]], SK.REPORT_STRUCT)
    stats = spark.createDataFrame([(19, 3, 0)], "total long, n_topics long, n_noise long")
    SK.save_snapshot(report, stats, str(tmp_path / "s"))
    assert [r.topic for r in SK.load_snapshot(spark, str(tmp_path / "s")).first().results] == [1, 2, 3]


def test_scratch_scope_removes_what_it_wrote(spark):
    import os

    from feedlens import session as S
    with S.scratch_scope(spark):
        kept = S.cut_lineage(spark.range(3))
        folder = S._SCRATCH[-1].removeprefix("file:")
        assert kept.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_workers_find_the_package_from_any_folder(tmp_path):
    import os
    import subprocess
    import sys
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {top!r})\n"
            "from feedlens.session import get_spark\n"
            "from feedlens.operators.lists import knn_lists\n"
            "s = get_spark('local[2]', partitions=2)\n"
            "d = s.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], 'doc_id long, vec array<double>')\n"
            "assert knn_lists(d, 1).count() == 9\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=300)
