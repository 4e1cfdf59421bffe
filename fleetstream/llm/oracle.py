"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10


def _folded(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


OP1 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_folded('text')}, '{ALNUM}') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least({WINDOW}, len(w)) AS size
  FROM (SELECT item_id, regexp_extract_all({_folded('text')}, '{ALNUM}') AS w FROM benchmark)
  WHERE len(w) > 0),
phrases AS (
  SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT item, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
  SELECT rid, i, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT rid, i, size, item FROM windows JOIN phrases USING (size, phrase)),
words_hit AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS j FROM hits) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words_hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(words_hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (rid) LEFT JOIN named USING (rid)
"""


# Fixed values, written out apart from the operators' own.
_STOPS = """
the be to of and that have with in is it for on as was this are by from
de la que el en los las un una del se con por para su es no
der die das den von zu mit sich des auf für ist im nicht ein eine als auch und
le les et du est qui dans pour sur au pas avec
"""
_STOPS = ", ".join(f"'{w}'" for w in _STOPS.split())
_BASE = "n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words"
_KEPT = f"""{_BASE} AND word_chars BETWEEN 2 * n_words AND 12 * n_words AND 10 * n_symbols <= n_words
    AND 5 * n_exclamations <= n_words AND 5 * n_dup_lines <= 2 * n_lines AND 100 * n_stop_words >= n_words"""
OP4 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, s, regexp_extract_all(s, '{WORDS}') AS w,
         list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS s FROM documents)),
windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
repeated AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 3)) AS j FROM repeated) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(s, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         len(regexp_extract_all(s, '!')) AS n_exclamations, len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       NOT ({_BASE}) AS base_failed, {_KEPT} AS kept
FROM m
"""

OP5 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), 'WORDS') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(reach.y) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.x = d.doc_id GROUP BY ALL
""".replace("UPPER", UPPER).replace("LOWER", LOWER).replace("WORDS", WORDS)


def _rho(table: str) -> str:
    """Prior strength of a level, from its groups ``good`` and ``n``."""
    return f"""(
  SELECT CASE WHEN m = 0 OR m IS NULL OR spread <= 0 OR spread IS NULL THEN 1 / 0.5 - 1
    ELSE 1 / least(greatest(CASE WHEN free > 0 THEN (q / spread - (m - 1)) / free ELSE 0.001 END,
                            0.001), 0.5) - 1 END AS strength
  FROM (SELECT count(*) AS m, any_value(p) * (1 - any_value(p)) AS spread,
               sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS free, sum(n * pow(good / n - p, 2)) AS q
        FROM {table}, whole WHERE n > 0))"""


# Longest first.
_URL_RULES = (
    ("allow", "www.example.com", "/en/"),
    ("block", "example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
    ("allow", "com", "/"),
)


def _chosen(rule: bool) -> str:
    cases = " ".join(
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') "
        f"THEN '{host + path if rule else verdict}'"
        for verdict, host, path in _URL_RULES
    )
    return f"CASE {cases} END"


OP8 = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages)),
per_host AS (
  SELECT host, CAST(coalesce(sum(quality), 0) AS DOUBLE) AS good, CAST(count(quality) AS DOUBLE) AS n
  FROM parts LEFT JOIN labels ON doc_id = page_id GROUP BY host),
hosts AS (
  SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM per_host),
domains AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY ALL),
whole AS (SELECT CASE WHEN sum(n) > 0 THEN sum(good) / sum(n) ELSE 0.5 END AS p, sum(n) AS total FROM hosts),
k AS (
  SELECT p, CASE WHEN total > 0 THEN s.strength ELSE 2.0 END AS s, CASE WHEN total > 0 THEN d.strength ELSE 2.0 END AS d,
         CASE WHEN total > 0 THEN h.strength ELSE 2.0 END AS h
  FROM whole, {_rho('suffixes')} s, {_rho('domains')} d, {_rho('hosts')} h),
by_suffix AS (SELECT suffix, (good + s * p) / (n + s) AS prior FROM suffixes, k),
by_domain AS (SELECT domain, (good + d * prior) / (n + d) AS prior FROM domains JOIN by_suffix USING (suffix), k),
shares AS (SELECT host, (good + h * prior) / (n + h) AS share, n + h AS size FROM hosts JOIN by_domain USING (domain), k),
bounds AS (SELECT host, share - 1.645 * sqrt(share * (1 - share) / (size + 1)) AS bound FROM shares)
SELECT page_id, host, path, {_chosen(True)} AS rule,
       coalesce({_chosen(False)},
                CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM parts JOIN bounds USING (host)
"""


# Kind, expression, group that is measured and its least length.
_SECRETS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 1),
    ("bearer", r"(?i:authorization)\x20*:\x20*(?i:bearer)\x20+[A-Za-z0-9._~+/-]{16,}", 0, 1),
)


def _matches(kind: str, pattern: str, group: int, least: int, order: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT rid, pos AS start, {order} AS ord, '{kind}' AS kind, pos + ml[i] AS stop
  FROM (SELECT rid, i, ml, checked, coalesce(list_sum(gl[1 : i]), 0) + coalesce(list_sum(ml[1 : i - 1]), 0) AS pos
        FROM (SELECT rid, list_transform(string_split_regex(s, '{pattern}'), lambda x: length(x)) AS gl,
                     list_transform(regexp_extract_all(s, '{pattern}'), lambda x: length(x)) AS ml,
                     regexp_extract_all(s, '{pattern}', {group}) AS checked,
                     unnest(range(1, len(regexp_extract_all(s, '{pattern}')) + 1)) AS i
              FROM d WHERE regexp_matches(s, '{pattern}')))
  WHERE length(checked[i]) >= {least}"""


_FOUND = " UNION ALL ".join(_matches(*rule, i) for i, rule in enumerate(_SECRETS))
_BASES = ("assign", "access", "hex")
_BASE_KINDS = ", ".join(f"'{kind}'" for kind in _BASES)
OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS s FROM documents),
found AS ({_FOUND}),
told AS (
  SELECT rid, kind, start, ord, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM found),
per AS (
  SELECT rid, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _BASES)},
         string_agg(span, ',' ORDER BY start, ord) FILTER (kind IN ({_BASE_KINDS})) AS base,
         string_agg(span, ',' ORDER BY start, ord) AS spans
  FROM told GROUP BY rid)
SELECT doc_id, {', '.join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in _BASES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (rid)
"""

def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes: eight shifts a byte, the first takes it in."""
    data = f"regexp_extract_all(hex(encode({text})), '..')"
    steps = f"flatten(list_transform({data}, lambda x: [CAST('0x' || x AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    shift = "lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), {shift}), 4294967295)"


def _climb(nodes: str, paths: str, depth: int) -> str:
    """Levels over ``nodes0(tree, idx, digest)``, walked by ``paths0(rid, tree, idx, fold, proof)``."""
    run = "OVER (PARTITION BY tree, idx // 8 ORDER BY idx ROWS BETWEEN"
    made = []
    for k in range(depth):
        made.append(f"""
{nodes}{k}_run AS (
  SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS active,
         coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {nodes}{k}),
{nodes}{k + 1} AS (
  SELECT tree, idx // 8 AS idx, sha256(string_agg(digest, '' ORDER BY idx)) AS digest
  FROM {nodes}{k}_run WHERE active GROUP BY tree, idx // 8
  UNION ALL SELECT tree, idx, digest FROM {nodes}{k}_run WHERE NOT active),
{paths}{k + 1} AS (
  SELECT p.rid, p.tree, CASE WHEN active THEN p.idx // 8 ELSE p.idx END AS idx,
         CASE WHEN active THEN sha256(l || fold || r) ELSE fold END AS fold,
         CASE WHEN active THEN proof || l || r ELSE proof END AS proof
  FROM {paths}{k} p JOIN {nodes}{k}_run n ON p.tree = n.tree AND p.idx = n.idx)""")
    return ",".join(made)


def _field(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


_LEAF = [_field(x) for x in ("doc_id", "source", "lang", "n_chars", "text")]
_FORGED = [*_LEAF[:-1], _field("text", f"translate(text, '{UPPER}', '{LOWER}')")]
# Eight levels serve 16 million rows of one language, three 512 languages.
OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
         sha256({' || '.join(_LEAF)}) AS leaf,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN sha256({' || '.join(_FORGED)}) END AS forged
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d),
node0 AS (SELECT tree, idx, leaf AS digest FROM leaves),
path0 AS (SELECT rid, tree, idx, coalesce(forged, leaf) AS fold, '' AS proof FROM leaves),
{_climb('node', 'path', 8)},
top0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, digest, tree AS name FROM node8),
way0 AS (
  SELECT p.rid, '' AS tree, t.idx, p.fold, p.proof FROM path8 p JOIN top0 t ON t.name = p.tree),
{_climb('top', 'way', 3)}
SELECT d.doc_id, d.leaf, s.digest AS subroot, t.digest AS root, sha256(w.proof) AS proof_sha256,
       w.fold AS folded_root, w.fold = t.digest AS verified
FROM d JOIN way3 w USING (rid) JOIN node8 s ON s.tree = d.tree, top3 t
"""

_CRC12 = _crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")
OP12 = f"""
WITH runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL),
said AS (
  SELECT c, CASE WHEN h % 97 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word
  FROM (SELECT run, c, {_CRC12} AS h FROM runs)),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM said WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (
  SELECT word, n, i, word[: i - 1] AS l, word[i + 1 :] AS r
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON w.word = c.l || c.r
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON w.word = c.l || c.r),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n
  FROM pairs GROUP BY word),
judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
         CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  WITH RECURSIVE walk AS (
    SELECT word, word AS here, form AS next FROM judged
    UNION ALL SELECT walk.word, judged.word, judged.form FROM walk JOIN judged ON judged.word = walk.next)
  SELECT word, here AS root FROM walk WHERE next IS NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN chain USING (word)
"""

ORACLES = {
    "op1_decontaminate": OP1,
    "op4_rules": OP4,
    "op5_jaccard": OP5,
    "op8_reputation": OP8,
    "op10_secrets": OP10,
    "op11_merkle": OP11,
    "op12_spelling": OP12,
}
