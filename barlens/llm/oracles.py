"""DuckDB statements of the operators that SQL can express, stated on their own:
by definition (all pairs, all windows, bit by bit), not by the operators' methods."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from barlens.llm import decontamination as X
from barlens.llm import license_scan as L
from barlens.llm import sharding as S

LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"


# The 256 remainders of CRC-32 and the checksum of the bytes given in hex as ``x``, ``n`` of them.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"""
CRC = """xor(list_reduce(
    list_concat([4294967295], list_transform(range(n), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
    lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295)"""


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


NEAR_DUP = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS g FROM d),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


def license_scan() -> str:
    """Base phrases place by place; every block of every template from its first to its last word."""
    phrases = " UNION ALL ".join(f"SELECT {_list(p.split())} AS p, '{label}' AS label" for p, label in L.PHRASES.items())
    templates = []
    for k, t in enumerate(L.TEMPLATES):
        words = [w.decode() for w in L.words_of(t.text.encode())]
        n = len(set(words))
        templates.append(f"SELECT {k} AS k, '{t.label}' AS label, {_list(sorted(set(words)))} AS t, {n} AS size, "
                         f"{L.need_of(n, L.CONTAINMENT)} AS need, {L.width_of(len(words))} AS width, "
                         f"{_list(t.must)}::VARCHAR[] AS must, {_list(t.never)}::VARCHAR[] AS never")
    word = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER}, {word}) AS w FROM documents),
ph AS ({phrases}),
tm AS MATERIALIZED ({" UNION ALL ".join(templates)}),
b AS (
  SELECT doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS pos FROM d, ph),
ba AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_distinct(list(label)) AS labels
  FROM b GROUP BY doc_id),
tok AS (SELECT k, unnest(t) AS word FROM tm),
hit AS MATERIALIZED (
  SELECT doc_id, k, pos, word FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d) JOIN tok USING (word)),
run AS (
  SELECT e.doc_id, e.k, e.pos AS last, min(s.pos) AS start, count(DISTINCT s.word) AS held
  FROM hit e JOIN tm USING (k) JOIN hit s ON s.doc_id = e.doc_id AND s.k = e.k AND s.pos BETWEEN e.pos - tm.width + 1 AND e.pos
  GROUP BY ALL),
blk AS MATERIALIZED (
  SELECT DISTINCT doc_id, label, start, last, -held::DOUBLE / size AS r1, -size AS r2, last - start + 1 AS length
  FROM run JOIN tm USING (k) JOIN d USING (doc_id)
  WHERE held >= need AND list_has_all(w[start + 1:last + 1], must)
    AND NOT list_has_any(w[greatest(0, last + 1 - width) + 1:start + width], never)),
top AS MATERIALIZED (
  SELECT * FROM blk b WHERE NOT EXISTS (
    SELECT 1 FROM blk o WHERE o.doc_id = b.doc_id AND o.label = b.label AND o.start <= b.last AND b.start <= o.last
      AND (o.r1, o.r2, o.length, o.start) < (b.r1, b.r2, b.length, b.start))),
me AS (
  SELECT doc_id, list(label) AS labels, max(-r1) AS share FROM top b WHERE NOT EXISTS (
    SELECT 1 FROM top o WHERE o.doc_id = b.doc_id AND o.label <> b.label AND o.start <= b.last AND b.start <= o.last
      AND (o.r1, o.r2) < (b.r1, b.r2))
  GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(ba.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(ba.labels, []), coalesce(me.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN ba USING (doc_id) LEFT JOIN me USING (doc_id)
"""


def decontamination() -> str:
    marks = "['.', '!', '?', ':', chr(10)]"
    token = "'[.!?:\\n]|[0-9]+(?:[.,][0-9]+)*|\\p{L}+'"

    def tokens(table: str, key: str) -> str:
        return f"""
  SELECT {key}, list_filter(list_transform(t, lambda x, i: {{'raw': lower(x), 'mark': list_contains({marks}, x), 'canon':
    CASE WHEN x[1] BETWEEN '0' AND '9' THEN '{X.NUM}'
         WHEN i > 1 AND t[i - 1][1] BETWEEN '0' AND '9' AND list_contains({_list(X.UNITS)}, lower(x)) THEN '{X.UNIT}'
         WHEN x[1] <> lower(x[1]) AND i > 1 AND NOT list_contains({marks}, t[i - 1]) THEN '{X.NAME}'
         ELSE lower(x) END}}), lambda s: NOT s.mark) AS toks
  FROM (SELECT {key}, regexp_extract_all(coalesce(text, ''), {token}) AS t FROM {table})"""

    return f"""
WITH i AS MATERIALIZED (
  SELECT item_id, toks, least(len(toks), {X.WINDOW}) AS width FROM ({tokens('benchmark', 'item_id')})
  WHERE len(toks) >= {X.MIN_TOKENS}),
iw AS MATERIALIZED (
  SELECT item_id, width, pos, list_transform(toks[pos + 1:pos + width], lambda s: s.canon) AS win, toks[pos + 1:pos + width] AS own
  FROM (SELECT *, unnest(range(0, len(toks) - width + 1)) AS pos FROM i)
  WHERE 2 * len(list_filter(toks[pos + 1:pos + width], lambda s: list_contains({_list(X.SLOTS)}, s.canon))) <= width),
ni AS (SELECT item_id, count(*) AS n_windows FROM iw GROUP BY item_id),
d AS MATERIALIZED ({tokens('documents', 'doc_id')}),
dw AS (
  SELECT doc_id, width, pos, list_transform(toks[pos + 1:pos + width], lambda s: s.canon) AS win
  FROM (SELECT doc_id, toks, width, unnest(range(0, len(toks) - width + 1)) AS pos
        FROM d, (SELECT DISTINCT width FROM iw) WHERE len(toks) >= width)),
met AS MATERIALIZED (
  SELECT doc_id, item_id, iw.pos AS pos, min(dw.pos) AS doc_pos FROM dw JOIN iw ON dw.win = iw.win AND dw.width = iw.width GROUP BY ALL),
enough AS MATERIALIZED (
  SELECT doc_id, item_id, n_windows, count(*) AS matched FROM met JOIN ni USING (item_id) GROUP BY ALL
  HAVING count(*) >= {X.CONTAINMENT} * n_windows),
v AS MATERIALIZED (
  SELECT DISTINCT doc_id, item_id, own[k].raw AS value, toks[doc_pos + k].raw AS image FROM (
    SELECT doc_id, item_id, own, doc_pos, toks, unnest(range(1, width + 1)) AS k
    FROM met JOIN enough USING (doc_id, item_id) JOIN iw USING (item_id, pos) JOIN d USING (doc_id))
  WHERE list_contains({_list(X.SLOTS)}, own[k].canon)),
o AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, value) AS images,
    count(*) OVER (PARTITION BY doc_id, item_id, image) AS origins FROM v),
w AS (
  SELECT doc_id, item_id, value, max(greatest(images, origins)) AS images, bool_and(value = image) AS same FROM o GROUP BY ALL),
j AS (
  SELECT doc_id, item_id, count(*) AS n_values, count(*) FILTER (images = 1) AS n_consistent, bool_and(same) AS same
  FROM w GROUP BY ALL)
SELECT doc_id, item_id, n_windows, matched, matched / n_windows AS containment, coalesce(n_values, 0)::BIGINT AS n_values,
  coalesce(n_consistent, 0)::BIGINT AS n_consistent,
  CASE WHEN coalesce(same, true) THEN 'exact' ELSE 're-parameterised' END AS kind
FROM enough LEFT JOIN j USING (doc_id, item_id)
WHERE coalesce(n_consistent, 0) >= {X.CONSISTENCY} * coalesce(n_values, 0)
"""


def sharding(shards: int) -> str:
    """CRC-32 byte by byte and the published jump loop in 128-bit integers."""
    steps = f"""
  SELECT doc_id, n, (key * {S.MULTIPLIER} + {S.INCREMENT}) % 18446744073709551616::HUGEINT AS key, j AS b,
    floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE
      / (((key * {S.MULTIPLIER} + {S.INCREMENT}) % 18446744073709551616::HUGEINT) // 8589934592 + 1)::DOUBLE))::BIGINT AS j
  FROM jump WHERE j < n"""
    return f"""
WITH RECURSIVE jump(doc_id, n, key, b, j) AS (
  SELECT * FROM (SELECT DISTINCT doc_id, unnest([{shards}, {shards + 1}])::BIGINT AS n,
    ((coalesce(doc_id, 0)::HUGEINT % 18446744073709551616) + 18446744073709551616) % 18446744073709551616 AS key, -1::BIGINT AS b, 0::BIGINT AS j
    FROM documents)
  UNION ALL{steps}),
place AS (SELECT doc_id, n, max(b)::INTEGER AS shard FROM jump GROUP BY ALL),
step AS (
  {CRC_TABLE}),
h AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
crc AS (
  SELECT doc_id, n + 1 AS size, {CRC} AS text_crc32
  FROM h, step),
r AS (
  SELECT c.doc_id, c.size::BIGINT AS size, c.text_crc32::BIGINT AS text_crc32, a.shard, g.shard AS grown_shard
  FROM crc c JOIN place a ON a.doc_id IS NOT DISTINCT FROM c.doc_id AND a.n = {shards}
  JOIN place g ON g.doc_id IS NOT DISTINCT FROM c.doc_id AND g.n = {shards + 1}),
nb AS (SELECT greatest(1, floor(sqrt(count(*)))::BIGINT // 16) AS n FROM documents)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY
    (('0x' || substr(md5(concat_ws(',', shard, doc_id, size, text_crc32, grown_shard)), 1, 4))::BIGINT * nb.n) // 65536,
    doc_id NULLS FIRST, size, text_crc32, grown_shard) - 1)::BIGINT AS slot, grown_shard
FROM r, nb
"""


# Near words by deletion: equal but for one place, or one is the other without a letter.
SPELLING = f"""
WITH RECURSIVE u AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{ascii_uppercase}', '{ascii_lowercase}') AS run
  FROM documents),
r AS MATERIALIZED (
  SELECT run, count(*) AS c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x, any_value(doc_id) AS doc_id
  FROM u WHERE length(run) >= 5 GROUP BY run, u.doc_id),
step AS ({CRC_TABLE}),
h AS (SELECT run, c, {CRC} AS h FROM (SELECT *, length(x) // 2 AS n FROM r), step),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
x AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
nb AS MATERIALIZED (
  SELECT DISTINCT a, b FROM (
    SELECT p.word AS a, q.word AS b FROM x p JOIN x q ON p.d = q.d AND p.i = q.i AND p.word <> q.word
    UNION ALL SELECT x.word, v.word FROM x JOIN v ON x.d = v.word
    UNION ALL SELECT v.word, x.word FROM x JOIN v ON x.d = v.word)),
g AS (
  SELECT a AS word, count(*) AS n_near, min((-o.n, b)) AS best FROM nb JOIN v o ON o.word = b GROUP BY a),
f AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * v.n THEN best[2] END AS form,
    CASE WHEN -best[1] >= 2 * v.n THEN -best[1] END AS form_n
  FROM v LEFT JOIN g USING (word)),
way(word, stop) AS (SELECT word, word FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = way.stop WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.stop AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM f JOIN way USING (word) JOIN f e ON e.word = way.stop WHERE e.form IS NULL
"""
