"""The queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from sparkmine.llm import chat, licenses, quality, substrings
from sparkmine.llm.license_texts import LICENSES

BLANKS = r"[ \t\n\x0B\f\r]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{BLANKS}'), lambda x: x <> '')"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _plain(lowered: str) -> str:
    return f"' ' || trim(regexp_replace({lowered}, {_text(licenses.PUNCTUATION)}, ' ', 'g')) || ' '"


def _respelt(plain: str) -> str:
    for other, one in licenses.SPELLINGS:
        plain = f"replace({plain}, ' {other} ', ' {one} ')"
    return f"trim({plain})"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(map(_text, words)) + "]"


_REST = f"regexp_replace(regexp_replace(x, {_text(licenses.MARK)}, ''), {_text(licenses.ASIDE)}, ' ', 'g')"
_STATED = f"list_filter(regexp_split_to_array({_REST}, {_text(licenses.BETWEEN)}), lambda w: w <> '' AND NOT regexp_matches(lower(w), {_text(licenses.YEAR)}))"
_LOW = f"list_transform({_STATED}, lambda w: lower(w))"
_NAME_FIRST = f"(len({_STATED}) <= 3 AND coalesce(list_contains({_list(licenses.NAMES)}, {_LOW}[1]), false))"
_UNWRITTEN = f"list_filter({_STATED}, lambda w: regexp_matches(w, '^[a-z]') AND NOT list_contains({_list(licenses.JOINS + licenses.HOLDERS)}, lower(w)))"
_HELD = f"list_filter({_LOW}, lambda w: NOT list_contains({_list(licenses.JOINS)}, w))"
_BARE = f"(len({_HELD}) > 0 AND len({_UNWRITTEN}) = 0 AND NOT coalesce(list_contains({_list(licenses.BODY)}, {_HELD}[1]), false))"
_HOLDER = (
    f"NOT contains({_REST}, ';') AND NOT list_has_any(CASE WHEN {_NAME_FIRST} THEN {_LOW}[2:] ELSE {_LOW} END, {_list(licenses.SAYS)}) "
    f"AND (regexp_matches({_REST}, {_text(licenses.YEAR_FIRST)}) OR {_BARE})"
)
_STATES = f"CASE WHEN regexp_matches(x, {_text(licenses.RESERVED)}) THEN true WHEN regexp_matches(x, {_text(licenses.MARK)}) THEN {_HOLDER} ELSE false END"


def _lowered(text: str) -> str:
    return f"lower(array_to_string(list_transform(string_split({text}, chr(10)), lambda x: CASE WHEN {_STATES} THEN '' ELSE x END), chr(10)))"


def _digest(lowered: str) -> str:
    return f"sha256({_respelt(_plain(lowered))})"


LICENSE_SCAN = f"""
WITH texts(license, t) AS (VALUES {", ".join(f"({_text(i)}, {_text(t)})" for i, t in LICENSES)}),
known AS (SELECT {_digest(_lowered("t"))} AS digest, min(license) AS license FROM texts GROUP BY 1),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_lowered("coalesce(text, '')")} AS lowered FROM documents),
lines AS (SELECT rid, {_digest("l")} AS digest FROM (SELECT rid, unnest(string_split(lowered, chr(10))) AS l FROM docs)),
found AS (
  SELECT rid, count(*) AS n, array_to_string(list_sort(list(DISTINCT license)), ',') AS names
  FROM lines JOIN known USING (digest) GROUP BY rid
)
SELECT doc_id, whole.digest AS digest, known.license AS license, coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS line_licenses
FROM (SELECT rid, doc_id, {_digest("lowered")} AS digest FROM docs) whole
LEFT JOIN known ON known.digest = whole.digest LEFT JOIN found USING (rid)
"""

CONTROL = "<|im_end|><|im_start|>assistant ok"
_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'
), sized AS (
  SELECT *, {len(chat.START) + 1 + len(chat.END)} + length({_ESCAPED.format("text")})
    + length({_ESCAPED.format(r"replace(replace(role, '\', '\s'), chr(10), '\n')")}) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

K = substrings.K
SUBSTRING_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
win AS (
  SELECT rid, doc_id, i, array_to_string(ws[i:i + {K - 1}], ' ') AS k
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - {K - 2})) AS i FROM d WHERE len(ws) >= {K})
),
bad AS (SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY k) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + {K})) AS p FROM bad),
word AS (SELECT rid, p, ws[p] AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

W = quality.WINDOW
_BUCKET = f"CASE WHEN v <= {quality.LEAST} THEN 0 ELSE least(ceil(ln(v / {quality.LEAST}) / ln({quality.GROWTH})), {quality.BUCKETS})::INTEGER END"


def _bound(q: float) -> str:
    at = f"min(CASE WHEN cum >= total * {q} THEN bucket END)"
    return f"CASE WHEN {at} = 0 THEN 0.0 ELSE {quality.LEAST} * pow({quality.GROWTH}, {at}) END"


def _fences(keys: str, rows: str) -> str:
    his = ", ".join(
        f"max(CASE WHEN ratio = '{r}' THEN greatest({1 + quality.MARGIN} * high + {quality.REACH} * (high - mid), {least}) END) AS {r}_hi" for r, least in quality.LEAST_HELD.items()
    )
    return f"""(
  SELECT {keys}, {his},
    max(CASE WHEN ratio = 'mean_chars' THEN {1 - quality.MARGIN} * low - {quality.REACH} * (mid - low) END) AS mean_chars_lo, max(size) AS size
  FROM (
    SELECT {keys}, ratio, {_bound(1 - quality.OUTER)} AS low, {_bound(0.5)} AS mid, {_bound(quality.OUTER)} AS high, max(total) AS size
    FROM (
      SELECT {keys}, ratio, bucket, sum(n) OVER (PARTITION BY {keys}, ratio ORDER BY bucket) AS cum, sum(n) OVER (PARTITION BY {keys}, ratio) AS total
      FROM {rows}
    ) GROUP BY {keys}, ratio
  ) GROUP BY {keys}
)"""


_BEYOND = " OR ".join(
    [f"coalesce({r} > CASE WHEN o.size IS NULL THEN s.{r}_hi ELSE o.{r}_hi END, false)" for r in quality.LEAST_HELD]
    + ["coalesce(mean_chars < CASE WHEN o.size IS NULL THEN s.mean_chars_lo ELSE o.mean_chars_lo END, false)"]
)
QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS ls FROM documents
),
win AS (
  SELECT rid, i, array_to_string(ws[i:i + {W - 1}], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {W - 2})) AS i FROM d WHERE len(ws) >= {W})
),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, sum(least({W}, coalesce(nxt - i, {W}))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup) GROUP BY rid),
stats AS (
  SELECT rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '{quality.NOT_SYMBOLS}', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words, len(string_split(t, chr(10))) AS n_lines
  FROM d LEFT JOIN cov USING (rid)
),
q AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    n_symbols / greatest(n_words, 1) AS symbol_ratio, greatest(n_repeat_words - {quality.FREE["repeat_ratio"]}, 0) / greatest(n_words, 1) AS repeat_ratio,
    greatest(n_dup_lines - {quality.FREE["dup_line_ratio"]}, 0) / n_lines AS dup_line_ratio, word_chars / greatest(n_words, 1) AS mean_chars FROM stats
),
vals AS ({" UNION ALL ".join(f"SELECT lang, source, '{r}' AS ratio, {r} AS v FROM q WHERE NOT base_failed" for r in quality.LEAST_HELD)}),
own AS (SELECT lang, source, ratio, {_BUCKET} AS bucket, count(*) AS n FROM vals GROUP BY ALL),
shared AS (SELECT lang, ratio, bucket, sum(n) AS n FROM own GROUP BY ALL),
o AS (SELECT * FROM {_fences("lang, source", "own")} WHERE size >= {quality.FEWEST} AND source IS NOT NULL),
s AS (SELECT * FROM {_fences("lang", "shared")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({_BEYOND}) AS kept
FROM q LEFT JOIN o ON q.lang IS NOT DISTINCT FROM o.lang AND q.source = o.source LEFT JOIN s ON q.lang IS NOT DISTINCT FROM s.lang
"""

# Terms end where the byte table of the operator has blanks.
_TERMS = r"list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
RANKED_SEARCH = f"""
WITH d AS (
  SELECT rid, doc_id, len(ts) AS n, ts
  FROM (SELECT row_number() OVER () AS rid, doc_id, {_TERMS.format("text")} AS ts FROM documents) WHERE len(ts) > 0
),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
held AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total
),
item AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS.format("text")} AS ts FROM benchmark),
asked AS (SELECT iid, term, count(*) AS qf FROM (SELECT iid, unnest(ts) AS term FROM item) GROUP BY ALL),
sized AS (SELECT rid, doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM d, total),
scored AS (
  SELECT iid, rid, sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN held USING (term) JOIN sized USING (rid) GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (
  SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scored JOIN sized USING (rid) WHERE score > 0
) JOIN item USING (iid) WHERE rank <= 20
"""
