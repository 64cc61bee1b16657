"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from medlattice.llm import ball_codes, license_scan, secret_scan

#: words, the windows of three words and the lines of every text, then the rules of policy ``v1``
QUALITY_RULES = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), win AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1)
  GROUP BY r
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_upper, length(regexp_replace(text, '[^!?]+', '', 'g')) AS n_marks
  FROM w LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)
), b AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END + CASE WHEN 4 * n_marks > n_words THEN 128 ELSE 0 END AS bits
  FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS fail_bits
FROM b
"""


#: shingles of items and of documents, for every shingle length that an item has
CONTAMINATION = r"""
WITH i AS (
  SELECT *, least(5, len(w)) AS k FROM (
    SELECT row_number() OVER () AS r, item_id, regexp_extract_all(lower(text), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') AS w FROM benchmark
  ) WHERE len(w) > 0
), items AS (
  SELECT DISTINCT r, item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM i)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') AS w FROM documents
), held AS (
  SELECT DISTINCT r, doc_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i))
), sizes AS (SELECT r, count(*) AS n FROM items GROUP BY r)
SELECT h.doc_id, i.item_id, count(*) AS shared, any_value(n) AS n_shingles
FROM items i JOIN held h ON i.k = h.k AND i.g = h.g JOIN sizes s ON s.r = i.r
GROUP BY h.r, h.doc_id, i.r, i.item_id HAVING count(*) >= 0.8 * any_value(n)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql() -> str:
    """Sentences, their identifiers, and the rules applied one after another to the sequence."""
    low = "lower(sentence)"
    speaks = " OR ".join(f"contains({low}, {_quoted(cue)})" for cue in license_scan.CUES)
    arms = " ".join(f"WHEN regexp_full_match(norm, {_quoted(pattern)}) THEN {_quoted(name)}" for name, pattern in license_scan.SENTENCES)
    trace = "coalesce('|' || array_to_string(list_transform(ids, lambda x: x || '|'), '|'), '')"
    for name, wanted in license_scan.RULES:
        trace = f"replace({trace}, {_quoted(''.join(f'|{i}|' for i in wanted))}, {_quoted(f'|<{name}>|')})"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), s AS (
  SELECT r, unnest(string_split(regexp_replace(text, '([.!?;])\s+', '\1' || chr(10), 'g'), chr(10))) AS sentence,
    generate_subscripts(string_split(regexp_replace(text, '([.!?;])\s+', '\1' || chr(10), 'g'), chr(10)), 1) AS pos FROM d
), n AS (
  SELECT r, pos, trim(regexp_replace(replace({low}, 'licence', 'license'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS norm FROM s WHERE {speaks}
), ids AS (SELECT r, list(CASE {arms} ELSE 'unknown' END ORDER BY pos) AS ids FROM n GROUP BY r)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  CASE WHEN ids IS NULL THEN '' ELSE array_to_string(regexp_extract_all({trace}, '<([^>]+)>', 1), ',') END AS licenses,
  coalesce(len(list_filter(ids, lambda x: x = 'unknown')), 0)::BIGINT AS n_unknown
FROM d LEFT JOIN ids USING (r)
"""


def secrets_sql() -> str:
    """Every pattern over every text, with positions from the pieces between its matches."""
    parts = []
    for number, rule in enumerate(secret_scan.RULES):
        pattern = _quoted(rule.pattern)
        parts.append(f"""
  SELECT r, start, {number} AS number, '{rule.kind}' AS kind, start + size AS stop FROM (
    SELECT r, list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start,
      length(found[i]) AS size, length(kept[i]) AS own
    FROM (
      SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT r, regexp_extract_all(text, {pattern}) AS found, regexp_extract_all(text, {pattern}, {rule.group}) AS kept,
          string_split_regex(text, {pattern}) AS pieces
        FROM d WHERE regexp_matches(text, {pattern})))
  ) WHERE own >= {rule.least}""")
    spans = "list(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) ORDER BY start, number)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.RULES if r.base)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), s AS ({" UNION ALL ".join(parts)}
), g AS (SELECT r, {counts}, array_to_string({spans} FILTER (WHERE number < 3), ',') AS base, array_to_string({spans}, ',') AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


#: classes of equal shingle sets, their links by counting shared shingles, and what is reachable by links
OVERLAP_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), '[^\x20]+') AS w FROM documents
), g AS (
  SELECT DISTINCT r, doc_id, hash(array_to_string(w[p : p + 4], ' ')) AS s FROM (SELECT r, doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS p FROM d WHERE len(w) > 0)
), n AS (SELECT r, doc_id, count(*) AS n, list(s ORDER BY s) AS body FROM g GROUP BY r, doc_id),
classes AS (SELECT body, min(r) AS r, any_value(n) AS n FROM n GROUP BY body),
gs AS (SELECT g.r, c.n, s FROM g JOIN classes c USING (r)),
links AS (
  SELECT a.r AS x, b.r AS y FROM gs a JOIN gs b ON a.s = b.s AND a.r < b.r AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), pairs AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT r AS x, r AS y FROM classes UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x),
root AS (SELECT x AS r, min(y) AS root FROM reach GROUP BY x),
placed AS (SELECT n.doc_id, n.n, root.root FROM n JOIN classes c ON n.body = c.body JOIN root ON root.r = c.r)
SELECT doc_id, n AS n_shingles, min(doc_id) OVER (PARTITION BY root) AS component_id FROM placed
UNION ALL SELECT doc_id, 0, doc_id FROM d WHERE len(w) = 0
"""


def codes_sql() -> str:
    """Rounds of k-means written out: every part against every entry, then means by component."""
    rounds = []
    for i in range(ball_codes.ROUNDS + 1):
        rounds.append(f"""near{i} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min({{'d': xx - 2 * list_inner_product(x, c) + list_inner_product(c, c), 'e': e}}) AS best FROM sized JOIN book{i} USING (p) GROUP BY r, p
), book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, c) AS c FROM book{i} LEFT JOIN (
    SELECT p, e, list(m ORDER BY j) AS m FROM (
      SELECT p, best.e AS e, j, floor(sum(x[j]) / count(*)) AS m FROM near{i}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS j) GROUP BY p, best.e, j
    ) GROUP BY p, e
  ) USING (p, e)
)""")
    last = ball_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({ball_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), parts AS (
  SELECT r, p, CAST(v[p * w + 1 : p * w + w] AS DOUBLE[]) AS x FROM (SELECT r, v, len(v) // {ball_codes.PARTS} AS w, unnest(range({ball_codes.PARTS})) AS p FROM kept)
), sized AS (SELECT r, p, x, list_inner_product(x, x) AS xx FROM parts
), book0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {ball_codes.ENTRIES}
), {", ".join(rounds)}, coded AS (
  SELECT r, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{last} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(CAST(c AS BIGINT[]), ','), ',' ORDER BY p, e)) FROM book{last}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""


#: crc32 bit by bit, the rebuilt turns, every prefix by a chain of digests, and all prefixes below each
CONVERSATION_TRIE = r"""
WITH RECURSIVE src AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM src GROUP BY c
), crc AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM own
  UNION ALL
  SELECT c, s, i + 1, list_reduce(list_prepend(xor(v, ascii(s[i + 1])), range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
  FROM crc WHERE i < length(s)
), heads AS (SELECT c, xor(v, 4294967295) % 6 AS h FROM crc WHERE i = length(s)),
whole AS (
  SELECT o.c, coalesce(p.turns[1 : h], []) || o.turns[h + 1 :] AS turns
  FROM own o JOIN heads USING (c) LEFT JOIN own p ON p.c = o.c - o.c % 100
), path AS (
  SELECT c, 0 AS d, md5('') AS node, CAST(NULL AS VARCHAR) AS up, CAST(0 AS BIGINT) AS n, len(turns) = 0 AS ends, turns FROM whole
  UNION ALL
  SELECT c, d + 1, md5(node || md5(turns[d + 1].r) || md5(turns[d + 1].t)), node, length(turns[d + 1].t), d + 1 = len(turns), turns FROM path WHERE d < len(turns)
), nodes AS (
  SELECT node, d, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM path GROUP BY node, d
), kids AS (SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT DISTINCT a.node AS top, b.node FROM path a JOIN path b ON a.c = b.c AND b.d >= a.d
), sums AS (
  SELECT top, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.n) AS saved_tokens
  FROM below JOIN nodes x USING (node) LEFT JOIN kids k USING (node) GROUP BY top
)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM nodes x LEFT JOIN nodes p ON p.node = x.up LEFT JOIN kids k ON k.node = x.node JOIN sums s ON s.top = x.node
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_sql(), "op2_contamination": CONTAMINATION, "op5_secret_scan": secrets_sql(),
        "op7_quality_rules": QUALITY_RULES, "op11_overlap_join": OVERLAP_JOIN, "op12_ball_codes": codes_sql(), "op13_conversation_trie": CONVERSATION_TRIE,
    }
