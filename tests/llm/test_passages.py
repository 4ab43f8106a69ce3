"""Repeated passages: every planted one over 50 words goes, whatever its number of lines."""
import random

from feedlens.llm import line_dedup as L

SCHEMA = "doc_id long, text string, gone string, lines string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "g", "l") for d, t in rows], SCHEMA)


def planted(seed=3):
    """Texts with passages of 2 to 8 lines and over 50 words, each in two texts among lines of their own."""
    rng = random.Random(seed)
    line = lambda tag, n: " ".join(f"{tag}{rng.randrange(10 ** 6)}" for _ in range(n))
    passages = ["\n".join(line("p", 60 // m + 1) for _ in range(m)) for m in (2, 3, 4, 5, 6, 8) for _ in range(10)]
    rows, at = [], 0
    for p in passages:
        for _ in range(2):
            at += 1
            rows.append((at, "\n".join([line("a", 9) for _ in range(rng.randint(0, 4))] + [p] + [line("b", 9) for _ in range(rng.randint(0, 4))])))
    return passages, rows


def share_removed(out, passages):
    """Share of the passages that stand in exactly one text, with no line of them left elsewhere."""
    lines = [x for t in out for x in t.split("\n")]
    return sum(all(lines.count(x) == 1 for x in p.split("\n")) for p in passages) / len(passages)


def test_all_planted_passages_are_removed(spark):
    passages, rows = planted()
    texts = lambda f: [r.text for r in f(table(spark, rows)).collect()]
    assert share_removed(texts(L.remove_repeated_passages), passages) == 1.0
    assert share_removed(texts(L.remove_repeated_chunks), passages) < 0.5


def passages_brute(rows):
    docs = [(d, n, None if t is None else t.split("\n")) for n, (d, t) in enumerate(rows)]
    seen, out = set(), []
    for d, n, ls in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        gone = set()
        for i in range(len(ls or []) - 1):
            w = (ls[i], ls[i + 1])
            if "".join(w).strip(" \t\n\x0b\x0c\r"):
                gone |= {i, i + 1} if w in seen else set()
                seen.add(w)
        left = None if ls is None else "\n".join(x for i, x in enumerate(ls) if i not in gone)
        out.append((d, left, len(ls or []), len(gone), sum(i - 1 not in gone for i in gone)))
    return sorted(out, key=repr)


def test_passages_equal_direct_comparison(spark):
    rng = random.Random(9)
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "\n\n\n"), (None, "a\nb"), (5, "x\nx\nx\nx"), (6, "a\nb\na\nb"), (7, "one"), (8, "one")]
    rows += [(10 + i, "\n".join(f"line {rng.randrange(12)}" for _ in range(rng.randint(0, 9)))) for i in range(60)]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.removed_lines, r.removed_passages)
                  for r in L.remove_repeated_passages(table(spark, rows)).collect()), key=repr)
    assert got == passages_brute(rows)
    # no line is lost from the corpus
    lines = lambda ts: {x for t in ts if t is not None for x in t.split("\n")}
    assert lines(t for _, t in rows) - {""} == lines(r[1] for r in got) - {""}


def test_passages_run_no_python(spark):
    assert L.remove_repeated_passages(table(spark, [])).count() == 0
    plan = L.remove_repeated_passages(table(spark, [(1, "a\nb")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
