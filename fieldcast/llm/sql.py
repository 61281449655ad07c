"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from fieldcast.llm import licences, rules

BLANK = "[\\x20\\x09-\\x0D]+"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _distance(counts: list[str], shares: list[str]) -> str:
    total = f"greatest({' + '.join(counts)}, 1)"
    terms = [
        f"(CASE WHEN {c} > 0 THEN ({c} / {total}) * log2(({c} / {total}) / (({c} / {total} + {q}) / 2)) ELSE 0.0 END"
        f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({c} / {total} + {q}) / 2)) ELSE 0.0 END)"
        for c, q in zip(counts, shares)]
    return f"sqrt(greatest(({' + '.join(terms)}) / 2, 0.0))"


def rules_sql() -> str:
    known = rules.vocabulary()
    at = {w: i for i, w in enumerate(known)}
    classes = [f"c{i}" for i in range(len(rules.CLASSES))]
    counted = ", ".join(
        f"length(t) - length(regexp_replace(t, {text(p)}, '', 'g')) AS k_{k}" for k, p in rules.PATTERNS.items())
    common = ", ".join(f"len(list_filter(wl, lambda x: x = {text(w)})) AS w{i}" for w, i in at.items())
    near, by_word = [], []
    for lang, (class_shares, word_shares) in rules.references().items():
        own = [f"w{at[w]}" for w in rules.COMMON_WORDS[lang]]
        mine = _distance([f"m.{x}" for x in own] + [f"(m.n_words - ({' + '.join('m.' + x for x in own)}))"],
                         [f"({q!r}::DOUBLE)" for q in word_shares])
        chars = _distance([f"m.{c}" for c in classes], [f"({q!r}::DOUBLE)" for q in class_shares])
        size = " + ".join(f"m.{c}" for c in classes)
        near.append(
            f"(({size} < {rules.MIN_CHARS} OR {chars} <= {rules.CLASS_LIMIT})"
            f" AND (m.n_words < {rules.MIN_COMMON} OR {mine} <= {rules.WORD_LIMIT}))")
        refs = [f"r.{x}" for x in own] + [f"(r.n - ({' + '.join('r.' + x for x in own)}))"]
        total = f"greatest({' + '.join(refs)}, 1)"
        theirs = _distance([f"m.{x}" for x in own] + [f"(m.n_words - ({' + '.join('m.' + x for x in own)}))"],
                           [f"({q} / {total})" for q in refs])
        by_word.append(f"WHEN {text(lang)} THEN round({theirs}, {rules.DIGITS})")
    total = f"greatest({' + '.join('r.' + c for c in classes)}, 1)"
    by_class = _distance([f"m.{c}" for c in classes], [f"(r.{c} / {total})" for c in classes])
    sums = ", ".join(f"sum({x}) AS {x}" for x in [*classes, *[f"w{i}" for i in at.values()]])
    listed = ", ".join(text(x) for x in rules.COMMON_WORDS)
    space = "length(t) - word_chars"
    plain = "word_chars - (" + " + ".join(f"k_{k}" for k in rules.PATTERNS) + ")"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{BLANK}'), lambda x: x <> '') AS w FROM d),
k AS (
  SELECT *, list_transform(w, lambda x: lower(x)) AS wl, {counted},
    length(regexp_replace(t, '{BLANK}', '', 'g')) AS word_chars,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM w),
windows AS (
  SELECT rid, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'i': i, 'x': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]}}),
    recursive := true) FROM w WHERE len(w) >= 3),
twice AS (
  SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, x) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
m AS (
  SELECT k.rid, doc_id, lang, len(w) AS n_words, word_chars, k_symbol AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    {space} AS c0, {', '.join(f'k_{k} AS c{i}' for i, k in enumerate(rules.PATTERNS, 1))},
    {plain} AS c{len(classes) - 1}, {common}
  FROM k LEFT JOIN covered USING (rid)),
r AS (SELECT lang, sum(n_words) AS n, {sums} FROM m WHERE lang IN ({listed}) GROUP BY lang),
f AS (
  SELECT m.*, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words AS base_failed,
    coalesce(m.lang IN ({listed}), false) AS listed, {' OR '.join(near)} AS near,
    CASE WHEN r.lang IS NOT NULL THEN round({by_class}, {rules.DIGITS}) END AS class_distance,
    CASE r.lang {' '.join(by_word)} END AS word_distance
  FROM m LEFT JOIN r ON m.lang = r.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (NOT listed OR near) AS kept, class_distance, word_distance FROM f"""


def licences_sql() -> str:
    known = ", ".join(
        f"({text(n)}, [{', '.join(text(b) for b in grams)}])" for n, grams in licences.templates())
    limit = licences.LIMIT
    return f"""
WITH t(licence, tb) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
pl AS (SELECT rid, regexp_split_to_array(text, {text(licences.PARAGRAPH)}) AS ps FROM d),
p AS (
  SELECT DISTINCT rid, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS s FROM (
    SELECT rid, text AS s FROM d
    UNION ALL SELECT rid, unnest(ps) FROM pl
    UNION ALL SELECT rid, unnest(string_split(text, chr(10))) FROM d
    UNION ALL SELECT rid, unnest(regexp_split_to_array(text, {text(licences.SENTENCE)})) FROM d
    UNION ALL SELECT rid, unnest(regexp_split_to_array(text, {text(licences.PART)})) FROM d
    UNION ALL SELECT rid, unnest(regexp_split_to_array(text, {text(licences.CLAUSE)})) FROM d
    UNION ALL SELECT rid, array_to_string(list_slice(ps, i, i + r - 1), chr(10) || chr(10)) FROM (
      SELECT rid, ps, r, unnest(range(1, len(ps) - r + 2)) AS i FROM pl, range(2, {licences.RUN} + 1) v(r)))
  WHERE s IS NOT NULL),
w AS (SELECT rid, s, string_split(s, ' ') AS w FROM p),
b AS (
  SELECT rid, s, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pb
  FROM w WHERE len(w) > 1),
m AS (
  SELECT rid, s, licence, len(tb) AS size, 2 * len(list_intersect(pb, tb)) / (len(pb) + len(tb)) AS dice
  FROM b JOIN t ON 2 * least(len(pb), len(tb)) >= {limit} * (len(pb) + len(tb))),
g AS (
  SELECT rid, min(struct_pack(worse := -dice, size := -size, licence := licence)) AS best,
    count(DISTINCT s) AS n_passages, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
  FROM m WHERE dice >= {limit} GROUP BY rid)
SELECT doc_id, best.licence AS licence, coalesce(-best.worse, 0.0) AS dice,
  coalesce(n_passages, 0) AS n_passages, coalesce(licences, '') AS licences
FROM d LEFT JOIN g USING (rid)"""


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s QUALIFY rank <= 5"""

ARCHIVES = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
r AS (
  SELECT *, row_number() OVER w AS nth, first_value(page_id) OVER w AS first_page
  FROM p WINDOW w AS (PARTITION BY t ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, octet_length(encode(t)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, 1 + 5 * (j // 4), 5) AS INTEGER) >> CAST(15 - 5 * (j % 4) AS INTEGER)) & 31), 1)),
    '') AS payload_digest,
  CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN nth > 1 THEN first_page END AS refers_to
FROM r"""

#: CRC-32 bit by bit (reversed polynomial 0xEDB88320), for a text of ASCII digits.
_CRC = """xor(list_reduce([4294967295] || list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: list_reduce([xor(c, b)] || range(8),
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

PREFIX_TRIE = f"""
WITH o AS (
  SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, c - c % 5 AS b, {_CRC.format("c")} % 9 AS h, count(*) AS own FROM o GROUP BY c),
shared AS (SELECT n.c, count(o.i) AS got FROM n LEFT JOIN o ON o.c = n.b AND o.i <= n.h GROUP BY n.c),
r AS (
  SELECT n.c, o.i AS d, o.role, o.text FROM n JOIN o ON o.c = n.b AND o.i <= n.h
  UNION ALL
  SELECT n.c, o.i - n.h + shared.got, o.role, o.text FROM n JOIN shared USING (c) JOIN o ON o.c = n.c AND o.i > n.h),
m AS (
  SELECT c, 0 AS d, '' AS k, NULL AS pk, 0 AS bytes FROM n
  UNION ALL
  SELECT c, d, k, CASE WHEN d = 1 THEN '' ELSE lag(k) OVER (PARTITION BY c ORDER BY d) END, bytes FROM (
    SELECT c, d, octet_length(encode(text)) AS bytes, string_agg(sha256(sha256(role) || sha256(text)), '')
      OVER (PARTITION BY c ORDER BY d) AS k FROM r)),
nodes AS (
  SELECT d, k, min(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved FROM m GROUP BY d, k),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY d, pk),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (d, k)),
sums AS (
  SELECT m.d, m.k, sum(CAST(f.n_children = 0 AS BIGINT)) AS n_leaves, sum(f.saved) AS saved_tokens
  FROM full_nodes f JOIN m ON m.c = f.conv_id AND m.d <= f.d GROUP BY m.d, m.k),
ends AS (
  SELECT m.d, m.k, sha256(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c)) AS ends_sha256
  FROM m JOIN (SELECT c, max(d) AS d FROM m GROUP BY c) USING (c, d) GROUP BY m.d, m.k)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_nodes f JOIN sums USING (d, k) LEFT JOIN ends USING (d, k) LEFT JOIN full_nodes p ON p.d = f.d - 1 AND p.k = f.pk"""


SQL = {"op2_topk": TOP_K, "op5_warc": ARCHIVES, "op3_rules": rules_sql(), "op10_licences": licences_sql(),
       "op12_prefixes": PREFIX_TRIE}
