"""Registered queries of the operators and their SQL.

``QUERIES`` and ``ORACLE`` have the form of ``plans.catalog``; the driver's
entry file adds them when this subpackage can be imported.
"""
from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_remainder, table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


WORD = r"[^\x20\x09-\x0D]+"


@register("op1_warc_normalise", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS top FROM p)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (substr(bits, i + 1, 5)::BIT::INT + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top AND top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM (SELECT *, (from_hex(sha1(payload))::BIT)::VARCHAR AS bits FROM g)""")
def op1(spark, sf):
    from .warc import archived
    return archived(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _learn_from(df: DataFrame) -> DataFrame:
    return df.where(crc32_remainder("doc_id", 3) != 1)


@register("op2_toxicity")
def op2(spark, sf):
    from . import toxicity
    docs = table(spark, sf, "documents")
    model = toxicity.train(_learn_from(docs), table(spark, sf, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (crc32_remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def _time_sql(u: str) -> str:
    """Training time (0..1) at which a source's weight schedule has spent the share ``u`` of its integral."""
    late = f"({u} - 0.375)"
    return (f"CASE WHEN {u} IS NULL THEN NULL ELSE CASE place % 3 WHEN 0 THEN least(1, 2 * {u} / (1.25 + sqrt(greatest(1.5625 - {u}, 0)))) "
            f"WHEN 1 THEN least(1, {u}) ELSE CASE WHEN {u} < 0.375 THEN least(0.5, 2 * {u} / (0.5 + sqrt(0.25 + 2 * {u}))) "
            f"ELSE least(1, 0.5 + 2 * {late} / (1 + sqrt(1 + 2 * {late}))) END END END")


@register("op3_curriculum_mix", f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight,
             2 * source_size AS cap FROM s),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
l AS (SELECT max(level) FILTER (WHERE weight * level < cap) AS level FROM f),
t AS (SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, CASE WHEN weight * f.level >= cap THEN cap::DOUBLE ELSE weight * l.level END AS target
      FROM f, l),
z AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS words FROM t),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.place,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0 AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CASE WHEN size > 0 AND middle <= target THEN middle / target END AS u1,
             CASE WHEN size > 0 AND middle + source_size <= target THEN (middle + source_size) / target END AS u2 FROM c)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 THEN 0 ELSE size * ((middle <= target)::INT + (middle + source_size <= target)::INT) END)::BIGINT AS taken,
       round({_time_sql("u1")} * words, 2) AS first_position, round({_time_sql("coalesce(u2, u1)")} * words, 2) AS last_position
FROM k, z""")
def op3(spark, sf):
    from .mixing import dealt
    return dealt(table(spark, sf, "documents"))[0].select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", F.round("first_position", 2).alias("first_position"),
        F.round("last_position", 2).alias("last_position"))


@register("op4_byte_bpe")
def op4(spark, sf):
    import public_tokenizers
    from .bpe import round_trip
    return round_trip(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op5_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM d""")
def op5(spark, sf):
    from .exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf, "documents"))


@register("op6_quality_cascade", rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
x AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
tri AS (SELECT rid, i, word, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3 FROM x WINDOW p AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS c FROM tri WHERE w3 IS NOT NULL),
cov AS (SELECT rid, count(DISTINCT i + o) AS n FROM rep, (VALUES (0), (1), (2)) v(o) WHERE c > 1 GROUP BY rid),
top AS (SELECT rid, max(c) AS n FROM (SELECT rid, word, count(*) AS c FROM x GROUP BY ALL) GROUP BY rid),
s AS (SELECT rid, doc_id, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))::BIGINT AS letters,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
b AS (SELECT s.*, len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(top.n, 0) AS top_word
      FROM s LEFT JOIN cov USING (rid) LEFT JOIN top USING (rid)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 2 * n_words <= word_chars AND word_chars <= 15 * n_words AND 10 * n_symbols <= n_words
       AND 10 * n_dup_lines <= 6 * n_lines AND 10 * top_word <= 2 * n_words AND 10 * letters >= 5 * word_chars AS kept
FROM v""")
def op6(spark, sf):
    from .quality import quality_cascade
    return quality_cascade(table(spark, sf, "documents"))


@register("op7_line_chunks", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(text, chr(10)) AS ls FROM documents),
h AS (SELECT *, list_transform(ls, lambda x: md5(x)) AS hs FROM d),
c AS (SELECT *, list_concat(list_concat([1], list_transform(list_filter(range(1, len(ls)), lambda i:
        substr(md5(CASE WHEN i > 1 THEN hs[i - 1] ELSE '' END || hs[i]), 1, 1) <= '3'), lambda i: i + 1)), [len(ls) + 1]) AS st FROM h),
k AS (SELECT rid, doc_id, st[j] AS b, st[j + 1] - st[j] AS n, array_to_string(ls[st[j]:st[j + 1] - 1], chr(10)) AS chunk
      FROM (SELECT *, unnest(range(1, len(st))) AS j FROM c WHERE ls IS NOT NULL)),
r AS (SELECT *, n >= 2 AND regexp_matches(chunk, '[^\x20\x09-\x0D]') AND row_number() OVER (
        PARTITION BY chunk, n >= 2 ORDER BY doc_id NULLS FIRST, rid, b) > 1 AS gone FROM k),
t AS (SELECT rid, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS removed_lines,
             count(*) FILTER (WHERE gone) AS removed_chunks, coalesce(string_agg(chunk, chr(10) ORDER BY b) FILTER (WHERE NOT gone), '') AS text
      FROM r GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(removed_lines, 0) AS removed_lines,
       coalesce(removed_chunks, 0) AS removed_chunks, sha256(text) AS text_sha256
FROM d LEFT JOIN t USING (rid)""")
def op7(spark, sf):
    from .line_dedup import remove_repeated_chunks
    return remove_repeated_chunks(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "removed_lines", "removed_chunks", F.sha2("text", 256).alias("text_sha256"))


@register("op7_line_passages", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(text, chr(10)) AS ls FROM documents),
k AS (SELECT rid, doc_id, i, ls[i] || chr(10) || ls[i + 1] AS win
      FROM (SELECT *, unnest(range(1, len(ls))) AS i FROM d WHERE ls IS NOT NULL)),
r AS (SELECT *, regexp_matches(win, '[^\x20\x09-\x0D]') AND row_number() OVER (
        PARTITION BY win ORDER BY doc_id NULLS FIRST, rid, i) > 1 AS later FROM k),
g AS (SELECT rid, list(i) AS gone FROM (SELECT rid, i FROM r WHERE later UNION SELECT rid, i + 1 FROM r WHERE later) GROUP BY rid)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS removed_lines,
       coalesce(len(list_filter(gone, lambda i: NOT list_contains(gone, i - 1))), 0)::BIGINT AS removed_passages,
       sha256(CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(ls) + 1),
           lambda i: NOT list_contains(gone, i)), lambda i: ls[i]), chr(10)) END) AS text_sha256
FROM (SELECT d.*, array_to_string(ls, chr(10)) AS text FROM d) LEFT JOIN g USING (rid)""")
def op7_passages(spark, sf):
    from .line_dedup import remove_repeated_passages
    return remove_repeated_passages(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "removed_lines", "removed_passages", F.sha2("text", 256).alias("text_sha256"))


@register("op8_language_id")
def op8(spark, sf):
    from . import language_id
    docs, pieces = table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model")
    model = language_id.train(_learn_from(docs), pieces)
    found = language_id.predict(docs, model, pieces)
    return found.select("doc_id", (crc32_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@register("op9_minhash_near_dedup")
def op9(spark, sf):
    from .near_dedup import near_dedup
    return near_dedup(table(spark, sf, "documents"))


@register("op10_elias_fano_tokens")
def op10(spark, sf):
    from .token_store import stored
    return stored(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


#: Unsigned crc32 of a short decimal text in SQL, bit by bit.
def _crc32_sql(text: str) -> str:
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({text}, ''), "
            "lambda ch: list_concat([ascii(ch)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))), "
            "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)")


@register("op11_prefix_trie", f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, c - c % 100 AS base, {_crc32_sql('c::VARCHAR')} % 6 AS h,
             list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, sha256(octet_length(encode(role)) || ':' || role || text)) AS ts
      FROM t GROUP BY c),
r AS (SELECT o.c, list_concat(coalesce(b.ts, [])[1:o.h], o.ts[o.h + 1:]) AS p FROM o LEFT JOIN o AS b ON b.c = o.base),
x AS (SELECT c, len(p) AS l, p, unnest(range(0, len(p) + 1)) AS d FROM r),
n AS (SELECT p[1:d] AS pre, d, min(c) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE l = d), '') AS ends
      FROM x GROUP BY ALL),
k AS (SELECT pre[1:d - 1] AS up, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(pre[d].text) END AS own
      FROM n LEFT JOIN k ON n.pre = k.up),
s AS (SELECT pre[1:a] AS pre, sum((n_children = 0)::INT) AS n_leaves, sum(own) AS saved_tokens
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM m) GROUP BY ALL)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s ON m.pre = s.pre LEFT JOIN n AS u ON m.d > 0 AND u.pre = m.pre[1:m.d - 1] AND u.d = m.d - 1""")
def op11(spark, sf):
    from .prefix_trie import prefix_trie
    return prefix_trie(table(spark, sf, "conversations")).drop("node")


@register("op12_minimum_bin_slack")
def op12(spark, sf):
    from .packing import packed
    return packed(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END"
        for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_TREE = """
  SELECT g, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (min(n) + 7) // 8
  FROM {t} WHERE n > 1 GROUP BY g, level, idx // 8"""


@register("op13_merkle_manifest", f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce('1' || lang, '0') AS g, {_leaf_sql('text')} AS leaf,
    CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS n FROM d),
low(g, level, idx, digest, n) AS (SELECT g, 0, idx, leaf, n FROM p UNION ALL {_TREE.format(t='low')}),
sub AS MATERIALIZED (SELECT g, digest, max(level) OVER (PARTITION BY g) AS top, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n
    FROM low WHERE n = 1),
high(g, level, idx, digest, n) AS (SELECT '', 0, place, digest, n FROM sub UNION ALL {_TREE.format(t='high')}),
root AS (SELECT digest FROM high WHERE n = 1),
steps AS MATERIALIZED (
  SELECT a.rid, b.level AS step, (a.idx >> (3 * b.level)) % 8 AS slot, list(b.digest ORDER BY b.idx) AS run
  FROM p a JOIN low b ON a.g = b.g AND b.n > 1 AND b.idx // 8 = a.idx >> (3 * b.level + 3) GROUP BY a.rid, a.idx, b.level
  UNION ALL
  SELECT a.rid, s.top + b.level, (s.place >> (3 * b.level)) % 8, list(b.digest ORDER BY b.idx)
  FROM p a JOIN sub s ON a.g = s.g JOIN high b ON b.n > 1 AND b.idx // 8 = s.place >> (3 * b.level + 3) GROUP BY a.rid, s.top, s.place, b.level),
proofs AS (SELECT rid, sha256(coalesce(string_agg(array_to_string(list_concat(run[1:slot], run[slot + 2:]), ''), '' ORDER BY step), '')) AS proof
  FROM steps GROUP BY rid),
fold(rid, step, cur) AS (SELECT rid, 0, coalesce(changed, leaf) FROM p UNION ALL
  SELECT f.rid, f.step + 1, sha256(array_to_string(s.run[1:s.slot], '') || f.cur || array_to_string(s.run[s.slot + 2:], ''))
  FROM fold f JOIN steps s ON f.rid = s.rid AND f.step = s.step),
done AS (SELECT rid, arg_max(cur, step) AS cur FROM fold GROUP BY rid)
SELECT p.doc_id, p.leaf, sub.digest AS subroot, root.digest AS root, coalesce(proofs.proof, sha256('')) AS proof_sha256,
       done.cur AS folded_root, done.cur = root.digest AS verified
FROM p JOIN sub ON p.g = sub.g JOIN done USING (rid) LEFT JOIN proofs USING (rid), root""")
def op13(spark, sf):
    from .merkle import verified
    return verified(table(spark, sf, "documents"))


def add_pipeline() -> None:
    """Registers ``pipeline`` if its file lies at the repository's top."""
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline
        QUERIES["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
