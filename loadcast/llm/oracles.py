"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_SPACE = r"[\x20\x09-\x0D]"


def _quality_sql() -> str:
    from loadcast.llm.quality import RULES, STOP_WORDS, SYMBOLS
    from loadcast.llm.text import LOWER, SPACE_CHARS, UPPER

    space = " || ".join([f"chr({ord(c)})" for c in SPACE_CHARS])
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    longest = max(map(len, STOP_WORDS)) + 1
    ratio = {
        "symbol_ratio": "n_symbols / greatest(n_words, 1)",
        "mean_word_chars": "word_chars / greatest(n_words, 1)",
        "stop_ratio": "n_stop_words / greatest(n_words, 1)",
        "stutter_ratio": "n_stutters / greatest(n_words, 1)",
        "dup_line_ratio": "n_dup_lines / greatest(n_text_lines, 1)",
    }
    tests = [f"({ratio[r.metric]}) {op} {float(limit)}::double" for r in RULES
             for op, limit in ((">=", r.low), ("<=", r.high)) if limit is not None]
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)),
                         lambda x: length(translate(x, {space}, '')) > 0) AS l FROM t),
windows AS (SELECT rid, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) > 8),
named AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS s FROM windows),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM named)
          WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM twice, range(8) AS r(o) GROUP BY rid),
m AS (SELECT doc_id, len(w)::bigint AS n_words,
             length(translate(t, {space}, ''))::bigint AS word_chars,
             (length(t) - length(translate(t, '{SYMBOLS}', '')))::bigint AS n_symbols,
             (len(l) - len(list_distinct(l)))::bigint AS n_dup_lines,
             len(l)::bigint AS n_text_lines, coalesce(n, 0)::bigint AS n_repeat_words,
             len(list_filter(w, lambda x: length(x) <= {longest} AND
                 rtrim(translate(x, '{UPPER}', '{LOWER}'), '.,;:!?') IN ({stops})))::bigint
                 AS n_stop_words,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::bigint AS n_stutters
      FROM w LEFT JOIN covered USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words,
       n_stutters, base_failed,
       CASE WHEN base_failed THEN false ELSE {' AND '.join(tests)} END AS kept
FROM f"""


ORACLES["op8_quality_rules"] = _quality_sql()


def _line_sql() -> str:
    from loadcast.llm.lines import MIN_CHARS, MIN_DOCS
    from loadcast.llm.text import LOWER, SPACE_CHARS, UPPER

    space = " || ".join([f"chr({ord(c)})" for c in SPACE_CHARS])
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l
           FROM documents),
x AS (SELECT rid, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM d),
k AS (SELECT rid, doc_id, line, pos,
             translate(trim(line, {space}), '{UPPER}', '{LOWER}') AS key FROM x),
common AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {MIN_CHARS}
           GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
f AS (SELECT k.*, common.key IS NOT NULL AND doc_id IS DISTINCT FROM last AS gone
      FROM k LEFT JOIN common USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::bigint AS n_lines,
       count(*) FILTER (gone)::bigint AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY rid"""


ORACLES["op6_line_dedup"] = _line_sql()


def _mix_sql() -> str:
    from loadcast.llm.mixing import HEX_DIGITS, POWER, SEED

    return f"""
WITH s AS (SELECT source, count(*) AS n, pow(count(*)::double, {POWER}) AS w FROM documents GROUP BY source),
r AS (SELECT source, w / (SELECT sum(w) FROM s) * (SELECT sum(n) FROM s)::double / n AS rate FROM s),
p AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::bigint + 1)) AS k FROM r),
c AS (SELECT source, k, sum(CASE WHEN k = 0 THEN exp(-rate)
                                 WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE 0 END)
             OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
u AS (SELECT *, row_number() OVER () AS rid,
             ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::varchar, 'null:' || md5(coalesce(text, '')))), 1, {HEX_DIGITS}))::bigint
             / {float(16 ** HEX_DIGITS)!r}::double AS u FROM documents),
n AS (SELECT rid, count(*)::int AS n_copies FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source
      WHERE cdf <= u GROUP BY rid),
x AS (SELECT u.* EXCLUDE (rid, u), n_copies, unnest(range(1, n_copies + 1))::int AS copy
      FROM u JOIN n USING (rid))
SELECT *, md5('{SEED}-order:' || coalesce(doc_id::varchar, 'null:' || md5(coalesce(text, ''))) || ':' || copy) AS shuffle_key FROM x"""


ORACLES["op7_source_mixing"] = _mix_sql()


def _topk_sql() -> str:
    from loadcast.llm.topk import ASKED, K, SCALE

    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) AS e
           FROM embeddings WHERE embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % {ASKED} = 0),
s AS (SELECT q.vec_id AS query_id, q.e, v.vec_id,
             list_inner_product(q.e::double[], v.e::double[])::bigint AS score
      FROM q JOIN v ON v.vec_id IS DISTINCT FROM q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id NULLS LAST)::int AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""


ORACLES["op11_topk_search"] = _topk_sql()


def _ranked_sql() -> str:
    from loadcast.llm.ranked import K
    from loadcast.llm.text import LOWER, UPPER

    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{term}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {terms} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS docs, sum(len(t))::bigint AS terms FROM d WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS iid, item_id, t
      FROM (SELECT DISTINCT item_id, text, {terms} AS t FROM benchmark WHERE text IS NOT NULL)),
a AS (SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
x AS (SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d),
p AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM x WHERE term IN (SELECT term FROM a) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint AS w FROM f, s),
g AS (SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS impact
      FROM p JOIN w USING (term), s),
r AS (SELECT iid, item_id, rid, doc_id, sum(times * impact)::bigint AS score FROM a JOIN g USING (term) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::int AS rank
      FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {K}"""


ORACLES["op12_ranked_search"] = _ranked_sql()
