"""A store of replies that survives lost tasks, reruns and packing."""
import glob
import os

import pytest

from feedlens.operators import replies as RP

PROMPTS = [(t, f"hash{t}", f"prompt {t}") for t in range(12)]


def prompts(spark):
    return spark.createDataFrame(PROMPTS, "topic int, prompt_hash string, prompt string")


def asking(folder, fail=()):
    """A backend that leaves a file for each call; prompts in ``fail`` bring the worker's task down the first time."""
    def backend(prompt):
        n = len(glob.glob(os.path.join(folder, prompt.replace(" ", "-") + "-*")))
        with open(os.path.join(folder, f"{prompt.replace(' ', '-')}-{n}-{os.getpid()}"), "w"):
            pass
        if prompt in fail and not n:
            raise KeyboardInterrupt  # no backend error: the task itself is lost
        return prompt.upper()
    return backend


def calls(folder):
    return sorted(os.path.basename(f).rsplit("-", 2)[0] for f in glob.glob(os.path.join(folder, "*")))


def test_one_call_a_prompt_over_reruns_and_packing(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    backend = asking(str(log))
    first = RP.generate_resumable(prompts(spark).where("topic < 5"), backend, store, "b", per_second=200.0).collect()
    assert all(r.ok and not r.cached and r.response == r.prompt.upper() for r in first)
    for _ in range(2):
        rows = RP.generate_resumable(prompts(spark), backend, store, "b").collect()
        assert sorted(r.topic for r in rows) == list(range(12)) and all(r.response == r.prompt.upper() for r in rows)
    assert calls(log) == sorted(f"prompt-{t}" for t in range(12))
    assert RP.pack_replies(spark, store) == 1 and RP.pack_replies(spark, store) == 2
    kept = RP.read_replies(spark, store).collect()
    assert len(kept) == 12 and {r.prompt_hash for r in kept} == {p[1] for p in PROMPTS}
    assert all(r.cached for r in RP.generate_resumable(prompts(spark), backend, store, "b").collect())
    # another backend's replies are its own
    assert not any(r.cached for r in RP.generate_resumable(prompts(spark), backend, store, "other").collect())


def test_a_lost_run_asks_for_the_rest_only(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    log.mkdir()
    backend = asking(str(log), fail=("prompt 7",))
    with pytest.raises(Exception):
        RP.generate_resumable(prompts(spark), backend, store, batch_size=100, in_flight=1).collect()
    rows = RP.generate_resumable(prompts(spark), backend, store, batch_size=100, in_flight=1).collect()
    assert sorted(r.topic for r in rows) == list(range(12)) and all(r.ok for r in rows)
    assert calls(log) == sorted([f"prompt-{t}" for t in range(12)] + ["prompt-7"])


def test_failures_are_rows_and_are_asked_again(spark, tmp_path):
    store = str(tmp_path / "store")

    def bad(prompt):
        raise ValueError("no")
    rows = RP.generate_resumable(prompts(spark), bad, store, max_retries=0).collect()
    assert all(not r.ok and r.response == "[ERROR: no]" for r in rows)
    assert RP.read_replies(spark, store).collect() == []
    assert all(r.ok and not r.cached for r in RP.generate_resumable(prompts(spark), str.upper, store).collect())


def test_pace_spreads_calls():
    import time
    pace, began = RP.Pace(50.0), time.monotonic()
    for _ in range(6):
        pace.wait()
    assert 0.09 < time.monotonic() - began < 0.5
