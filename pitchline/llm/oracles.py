"""DuckDB SQL for what SQL can express of the operators: whole results, or the base columns of a contract."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _documents(words: str) -> str:
    return f"SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {words} AS w FROM documents"


def _at(words: str) -> str:
    """A row for each word, numbered from 1."""
    return f"SELECT r, doc_id, unnest({words}) AS word, unnest(range(1, len({words}) + 1)) AS p FROM d"


def _windows(size: int) -> str:
    """A row for each window with its words as one text."""
    return f"SELECT r, doc_id, i, array_to_string(w[i:i + {size - 1}], ' ') AS k FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM d WHERE len(w) >= {size})"


LICENSE_BASE = f"""WITH d AS ({_documents(f"regexp_extract_all({_LOWER}, '{_LETTERS}')")}),
a AS ({_at("w")}),
n AS (SELECT r, p, word, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM a WINDOW o AS (PARTITION BY r ORDER BY p)),
h AS (SELECT r, p - 1 AS place, CASE WHEN word = 'mit' AND b = 'license' THEN 'mit' WHEN word = 'apache' AND b = 'license' THEN 'apache' WHEN word = 'general' AND b = 'public' AND c = 'license' THEN 'gpl' END AS label FROM n),
g AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h WHERE label IS NOT NULL GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels FROM d LEFT JOIN g USING (r)"""

# The base kinds with their patterns, in their order.
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _spans(order: int, kind: str, pattern: str) -> str:
    """Matches with their places: what stands between them tells where they start."""
    return f"""SELECT r, {order} AS o, '{kind}' AS kind, s, between, sum(len(between) + len(s)) OVER (PARTITION BY r ORDER BY k) - len(s) AS start
 FROM (SELECT r, unnest(m) AS s, unnest(b[1:len(m)]) AS between, unnest(range(len(m))) AS k FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS b FROM d))"""


PII_BASE = f"""WITH d AS ({_documents("NULL")}),
m AS ({" UNION ALL ".join(_spans(i, *kind) for i, kind in enumerate(_KINDS))}),
x AS (SELECT *, row_number() OVER () AS id, regexp_replace(s, '[^0-9]', '', 'g') AS digits FROM m),
luhn AS (SELECT id, sum(CASE WHEN place % 2 = 0 THEN v WHEN v > 4 THEN 2 * v - 9 ELSE 2 * v END) AS total
 FROM (SELECT id, unnest(range(len(digits))) AS place, CAST(unnest(string_split(reverse(digits), '')) AS INTEGER) AS v FROM x WHERE kind = 'card' AND len(digits) BETWEEN 14 AND 19) GROUP BY id),
parts AS (SELECT id, bool_and(len(ltrim(part, '0')) <= 3 AND CAST('0' || left(ltrim(part, '0'), 3) AS INTEGER) <= 255) AS good FROM (SELECT id, unnest(string_split(s, '.')) AS part FROM x WHERE kind = 'ip') GROUP BY id),
f AS (SELECT x.* FROM x LEFT JOIN luhn USING (id) LEFT JOIN parts USING (id)
 WHERE CASE kind WHEN 'email' THEN true WHEN 'ip' THEN good WHEN 'card' THEN coalesce(total % 10 = 0, false) ELSE len(digits) BETWEEN 10 AND 15 END),
g AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, _ in _KINDS)}, string_agg(kind || ':' || start || ':' || (start + len(s)), ',' ORDER BY start, o) AS said FROM f GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, _ in _KINDS)}, sha256(coalesce(said, '')) AS base_sha256 FROM d LEFT JOIN g USING (r)"""

QUALITY_BASE = f"""WITH d AS ({_documents(f"regexp_extract_all(coalesce(text, ''), '{_WORD}')")}),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '{_WORD}') GROUP BY r),
s AS ({_windows(8)}),
again AS (SELECT r, i FROM s QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM (SELECT r, i, unnest(range(8)) AS j FROM again) GROUP BY r),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
 coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN lines USING (r) LEFT JOIN covered USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c"""

PASSAGES = f"""WITH d AS ({_documents(f"regexp_extract_all(coalesce(text, ''), '{_WORD}')")}),
s AS (SELECT * FROM ({_windows(50)}) WHERE doc_id IS NOT NULL),
f AS (SELECT k, min(doc_id) AS low FROM s GROUP BY k),
gone AS (SELECT DISTINCT r, i + j AS p FROM (SELECT r, i, unnest(range(50)) AS j FROM s JOIN f USING (k) WHERE doc_id > low)),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS said FROM ({_at("w")}) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(said, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

# Windows that share no shingle with an item have similarity 0.
DECONTAMINATION = f"""WITH d AS (SELECT * FROM ({_documents(f"regexp_extract_all({_LOWER}, '{_LETTERS}')")}) WHERE len(w) > 0),
b AS (SELECT * FROM (SELECT row_number() OVER () AS t, item_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM benchmark) WHERE len(w) > 0),
ds AS (SELECT r, unnest(range(greatest(1, len(w) - 4))) AS p, array_to_string(w[unnest(range(greatest(1, len(w) - 4))) + 1:unnest(range(greatest(1, len(w) - 4))) + 5], ' ') AS g FROM d),
bs AS (SELECT t, array_to_string(w[i + 1:i + 5], ' ') AS g FROM (SELECT t, w, unnest(range(greatest(1, len(w) - 4))) AS i FROM b)),
bc AS (SELECT t, g, count(*) AS c FROM bs GROUP BY t, g),
size AS (SELECT t, item_id, len(w) AS n FROM b),
hit AS (SELECT DISTINCT r, t, p FROM ds JOIN bc USING (g)),
fit AS (SELECT r, t, p, least(n, len(d.w)) AS words, greatest(1, least(n, len(d.w)) - 4) AS wide, greatest(1, len(d.w) - 4) AS every FROM hit JOIN d USING (r) JOIN size USING (t)),
win AS (SELECT DISTINCT r, t, words, wide, start FROM (SELECT *, unnest(range(greatest(0, p - wide + 1), least(p, every - wide) + 1)) AS start FROM fit)),
wg AS (SELECT r, t, words, wide, start, g, count(*) AS c FROM win JOIN ds USING (r) WHERE p >= start AND p < start + wide GROUP BY ALL),
met AS (SELECT wg.r, wg.t, words, wide, start, sum(least(wg.c, bc.c)) AS same FROM wg JOIN bc ON wg.t = bc.t AND wg.g = bc.g GROUP BY ALL),
sim AS (SELECT r, t, words, start, CAST(same AS DOUBLE) / CAST(wide + total - same AS DOUBLE) AS similarity FROM met JOIN (SELECT t, sum(c) AS total FROM bc GROUP BY t) USING (t))
SELECT doc_id, item_id, similarity, CAST(start AS BIGINT) AS first_word, CAST(words AS BIGINT) AS words FROM sim JOIN (SELECT r, doc_id FROM d) USING (r) JOIN size USING (t) WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, words DESC) = 1"""


def _clustering(rounds: int = 3, k: int = 16, dimensions: int = 64) -> str:
    """Centroids after each round as rows (number, dimension, value)."""
    steps = [f"""v AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dimensions}),
x AS (SELECT r, unnest(range({dimensions})) AS d, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v),
c0 AS (SELECT n, d, x AS c FROM (SELECT r, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS n FROM v QUALIFY n < {k}) JOIN x USING (r))"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (SELECT r, n, dist FROM (SELECT r, n, CAST(sum((x - c) * (x - c)) AS BIGINT) AS dist FROM x JOIN c{i} USING (d) GROUP BY r, n) QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, n) = 1)""")
        if i < rounds:  # CAST of a floor division of integers: // rounds towards zero
            steps.append(f"""m{i} AS (SELECT n, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS k FROM a{i} JOIN x USING (r) GROUP BY n, d),
c{i + 1} AS (SELECT n, d, coalesce((s - ((s % k) + k) % k) // k, c) AS c FROM c{i} LEFT JOIN m{i} USING (n, d))""")
    return f"""WITH {", ".join(steps)},
h AS (SELECT n, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY n)
SELECT vec_id, CAST(n AS INTEGER) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h USING (n)"""


# crc32 is written as sums over bits: its remainder modulo 7 needs the whole value.
LM_BASE = f"""WITH d AS ({_documents(f"regexp_extract_all({_LOWER}, '{_WORD}')")}),
digit AS (SELECT doc_id, unnest(range(len(CAST(doc_id AS VARCHAR)))) AS i, ord(substr(CAST(doc_id AS VARCHAR), 1 + unnest(range(len(CAST(doc_id AS VARCHAR)))), 1)) AS b FROM (SELECT DISTINCT doc_id FROM d WHERE doc_id IS NOT NULL)),
bytes AS (SELECT doc_id, list(b ORDER BY i) AS b FROM digit GROUP BY doc_id),
crc AS (SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(b, lambda y: CAST(y AS BIGINT))),
 lambda c, y: xor(c >> 8, list_reduce(list_prepend(xor(c & 255, y), range(8)), lambda z, s: CASE WHEN z & 1 = 1 THEN xor(z >> 1, CAST(3988292384 AS BIGINT)) ELSE z >> 1 END))), CAST(4294967295 AS BIGINT)) AS h FROM bytes),
t AS (SELECT r, doc_id, coalesce(h, 0) % 7 = 2 AS held_out, list_append(w, ' ') AS w FROM d LEFT JOIN crc USING (doc_id)),
a AS (SELECT r, held_out, unnest(w) AS word FROM t),
c AS (SELECT word, count(*) AS c FROM a WHERE NOT held_out GROUP BY word),
n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c),
s AS (SELECT r, count(*) AS n_tokens, count(c) AS n_known, sum(log10((coalesce(c, 0) + 1) / CAST(n + v + 1 AS DOUBLE))) AS s FROM a LEFT JOIN c USING (word) CROSS JOIN n GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, CAST(n AS BIGINT) AS train_tokens, round(s, 4) AS base_score FROM t JOIN s USING (r) CROSS JOIN n"""

SQL = {"op12_clustering": _clustering(), "lm_base": LM_BASE, "op7_decontamination": DECONTAMINATION, "op8_substring_dedup": PASSAGES, "license_base": LICENSE_BASE, "pii_base": PII_BASE, "quality_base": QUALITY_BASE}
