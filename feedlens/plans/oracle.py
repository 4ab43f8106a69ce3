"""DuckDB oracle SQL for the registered queries.

Each string runs on the driver tables pre-registered as views.  The fragments
below restate the operator semantics in DuckDB's dialect (RE2 regexes, list
lambdas) so the comparison is against an independent engine.
"""
from __future__ import annotations

from ..operators.text import DEFAULT_STOPWORDS

# DuckDB spelling of the 29 whitespace code points and the word-token class.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{M}\p{N}_]{2,}"
WORD_ANY = r"[\p{L}\p{M}\p{N}_]+"
LINES = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = "[" + ", ".join(q(w) for w in dict.fromkeys(DEFAULT_STOPWORDS)) + "]"


def clean(col: str) -> str:
    return f"trim(regexp_replace(lower({col}), '{WS}+', ' ', 'g'))"


def strip(col: str) -> str:
    return f"regexp_replace({col}, '^{WS}+|{WS}+$', '', 'g')"


def stop(col: str) -> str:
    return (f"array_to_string(list_filter(string_split_regex({col}, '{WS}+'), "
            f"lambda t: t <> '' AND NOT list_contains({STOP_LIST}, t)), ' ')")


def min_chars(col: str, n: int) -> str:
    return f"({strip(col)} <> '' AND length(replace({col}, '_', ' ')) >= {n})"


def tokens(col: str, pattern: str = WORD) -> str:
    return f"regexp_extract_all(lower({col}), '{pattern}')"


FEEDBACK = "fb AS (SELECT doc_id::BIGINT AS doc_id, coalesce(CAST(text AS VARCHAR), '') AS text FROM documents)"

PREPARED = (
    FEEDBACK + ",\n"
    f"cl AS (SELECT doc_id, text, {stop(clean('text'))} AS clean FROM fb),\n"
    f"fl AS (SELECT * FROM cl WHERE {min_chars('clean', 3)}),\n"
    "pre AS (SELECT doc_id, text, clean FROM (SELECT *, row_number() OVER (PARTITION BY clean ORDER BY doc_id) AS rn FROM fl) WHERE rn = 1)"
)

def fixture_topics(name: str = "ft", threshold: int = 200) -> str:
    return (f"{name} AS (SELECT doc_id, (CASE WHEN n_chars < {threshold} THEN -1 WHEN lang = 'en' THEN 0 WHEN lang = 'fr' THEN 1 "
            "WHEN lang = 'de' THEN 2 WHEN lang = 'es' THEN 3 ELSE -1 END)::INTEGER AS topic FROM documents)")


FIXTURE_TOPICS = fixture_topics()


def ctfidf_ctes(x: str = "", ft: str = "ft") -> str:
    """c-TF-IDF CTE chain over ``pre`` and topic table ``ft``; CTE names get suffix ``x``."""
    return (
        f"pt0{x} AS (SELECT p.doc_id, p.clean, f.topic FROM pre p JOIN {ft} f USING (doc_id)),\n"
        f"tc{x} AS (SELECT topic, word, count(*)::BIGINT AS n FROM (SELECT topic, unnest({tokens('clean')}) AS word FROM pt0{x}) GROUP BY topic, word),\n"
        f"ptot{x} AS (SELECT topic, sum(n)::BIGINT AS topic_total FROM tc{x} GROUP BY topic),\n"
        f"pw{x} AS (SELECT word, sum(n)::BIGINT AS word_total FROM tc{x} GROUP BY word),\n"
        f"aw{x} AS (SELECT floor(sum(topic_total) / count(*))::BIGINT AS avg_words FROM ptot{x}),\n"
        f"idf{x} AS (SELECT word, ln(1.0::DOUBLE + avg_words / word_total) AS idf FROM pw{x}, aw{x}),\n"
        f"sc{x} AS (SELECT topic, word, n, n / topic_total * idf AS score FROM tc{x} JOIN ptot{x} USING (topic) JOIN idf{x} USING (word)),\n"
        f"tw{x} AS (SELECT topic, word, score, row_number() OVER (PARTITION BY topic ORDER BY score DESC, word) AS rank FROM sc{x})"
    )


CTFIDF = PREPARED + ",\n" + FIXTURE_TOPICS + ",\n" + ctfidf_ctes()


def words_joined(src: str, n: int, sep: str, name: str) -> str:
    return (f"SELECT topic, string_agg(word, {q(sep)} ORDER BY rank) AS {name} FROM {src} "
            f"WHERE rank <= {n} GROUP BY topic")


CANNED_REPLY = (
    "(CASE topic % 4 WHEN 0 THEN 'CẢM XÚC: tiêu cực' || chr(10) || 'TÓM TẮT: Khách hàng nói về ' || kw "
    "WHEN 1 THEN 'Sentiment: positive' || chr(10) || 'Sentiment: negative' || chr(10) || 'Summary: ' || kw || ': chi tiết' "
    "WHEN 2 THEN 'cam xuc: tich cuc' || chr(10) || chr(10) || '  ' || kw || '  ' || chr(10) || 'TÓM TẮT:' "
    "ELSE kw END)"
)


def _starts_any(x: str, prefixes) -> str:
    return "(" + " OR ".join(f"starts_with(lower({x}), {q(p)})" for p in prefixes) + ")"


def _contains_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def _after_colon(x: str) -> str:
    return f"(CASE WHEN instr({x}, ':') > 0 THEN substr({x}, instr({x}, ':') + 1) ELSE NULL END)"


def parse_sql(raw: str) -> tuple[str, str]:
    """(sentiment_expr, summary_expr) over a reply expression ``raw``."""
    from ..functions.parse import (NEGATIVE, NEGATIVE_WORDS, NEUTRAL, POSITIVE, POSITIVE_WORDS,
                                   SENTIMENT_PREFIXES, SUMMARY_PREFIXES)
    r = f"coalesce({raw}, '')"
    lines = f"list_filter(list_transform(string_split_regex({r}, '{LINES}'), lambda l: {strip('l')}), lambda l: l <> '')"
    sent_lines = f"list_filter({lines}, lambda l: {_starts_any('l', SENTIMENT_PREFIXES)})"
    last = f"({sent_lines})[-1]"
    val = f"coalesce(lower({_after_colon(last)}), '')"
    sentiment = (f"(CASE WHEN {last} IS NULL THEN {q(NEUTRAL)} WHEN {_contains_any(val, NEGATIVE_WORDS)} THEN {q(NEGATIVE)} "
                 f"WHEN {_contains_any(val, POSITIVE_WORDS)} THEN {q(POSITIVE)} ELSE {q(NEUTRAL)} END)")
    kept = (f"list_filter(list_transform({lines}, lambda l: CASE WHEN {_starts_any('l', SENTIMENT_PREFIXES)} THEN NULL "
            f"WHEN {_starts_any('l', SUMMARY_PREFIXES)} THEN nullif({strip(_after_colon('l'))}, '') ELSE l END), "
            "lambda l: l IS NOT NULL)")
    joined = strip(f"array_to_string({kept}, ' ')")
    summary = f"(CASE WHEN {joined} = '' THEN {strip(r)} ELSE {joined} END)"
    return sentiment, summary


def template_sql() -> str:
    from ..operators.summarize import ANSWER_FORMAT, DEFAULT_TEMPLATE
    return q(DEFAULT_TEMPLATE), q(ANSWER_FORMAT)


def md5_int(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


def hashed_vectors(dim: int = 64) -> str:
    """CTEs ending in hv(doc_id, dim, value) and dv(doc_id, v DOUBLE[]) over ``pre``."""
    return (
        f"hdt AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest({tokens('clean')}) AS word FROM pre) GROUP BY ALL),\n"
        "hn AS (SELECT count(*) AS n FROM pre),\n"
        f"voc AS (SELECT word, ln((max(n) + 1)::DOUBLE / (count(*) + 1)::DOUBLE) AS idf, ({md5_int('word')} % {dim})::INTEGER AS bucket, "
        f"CASE WHEN (({md5_int('word')} >> 16) & 1) = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign FROM hdt, hn GROUP BY word),\n"
        "bs AS (SELECT doc_id, bucket, sum(sign * tf * idf) AS v FROM hdt JOIN voc USING (word) GROUP BY ALL),\n"
        f"dims AS (SELECT p.doc_id, g.i::INTEGER AS dim FROM pre p, range({dim}) g(i)),\n"
        "dense AS (SELECT d.doc_id, d.dim, coalesce(bs.v, 0.0::DOUBLE) AS v FROM dims d LEFT JOIN bs ON d.doc_id = bs.doc_id AND d.dim = bs.bucket),\n"
        "nrm AS (SELECT doc_id, sqrt(sum(v * v)) AS nr FROM dense GROUP BY doc_id),\n"
        "hv AS (SELECT doc_id, dim, CASE WHEN nr > 0 THEN v / nr ELSE 0.0::DOUBLE END AS value FROM dense JOIN nrm USING (doc_id)),\n"
        "dv AS (SELECT doc_id, list(value ORDER BY dim) AS v FROM hv GROUP BY doc_id)"
    )


EMB = "ev AS (SELECT vec_id::BIGINT AS id, embedding::DOUBLE[] AS v FROM embeddings)"
EMB_PAIRS = (EMB + ",\nep AS (SELECT a.id AS src, b.id AS dst, "
             "sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist "
             "FROM ev a, ev b WHERE a.id <> b.id),\n"
             "ek AS (SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY round(dist, 9), dst) AS rank FROM ep)")
