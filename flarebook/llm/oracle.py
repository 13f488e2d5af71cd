"""What the operators must return, in SQL over the given tables, where SQL can say it.

Tokens, trained networks and approximate searches are not here; their queries
are tested against brute force.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"


CHAT = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length('<|im_start|>' || replace({_escaped('role')}, chr(10), '&#10;') || chr(10) || {_escaped('text')}
    || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

# 20 bits at a time: five hex digits are four digits of base 32.
_DIGITS = " || ".join(
    f"substr('{BASE32}', CAST((CAST('0x' || substr(hexed, {5 * part + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER) + 1, 1)"
    for part in range(8)
    for shift in (15, 10, 5, 0)
)
ARCHIVES = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hexed,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reached AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
least_id AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id <= coalesce(b, doc_id) AS kept
FROM sets LEFT JOIN least_id ON doc_id = a
"""

REPEATS = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hexed FROM documents),
strings AS (
  SELECT doc_id, i, md5(substr(hexed, 2 * i + 1, 400)) AS digest
  FROM (SELECT doc_id, hexed, unnest(range(0, strlen(hexed) // 2 - 199)) AS i FROM t)
),
again AS (SELECT digest FROM strings GROUP BY digest HAVING count(*) > 1),
starts AS (SELECT doc_id, i FROM strings SEMI JOIN again USING (digest)),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens
  FROM starts
),
numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
),
parts AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(hexed, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM gaps JOIN t USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(strlen(hexed) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(hexed, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN parts USING (doc_id)
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS k
  FROM documents
),
blocked AS (SELECT *, CAST('0x' || substr(k, 1, 8) AS BIGINT) % 256 AS block FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
),
weighed AS (
  SELECT *, CAST([5, 2, 1][place % 3 + 1] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS most FROM sources
),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
    - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
),
targets AS (SELECT *, least(most, weight * max(level) OVER ()) AS target FROM levels),
parted AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM targets
),
ordered AS (
  SELECT b.doc_id, b.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
    coalesce(sum(b.size) OVER (PARTITION BY p.place ORDER BY b.block, b.k, b.doc_id, b.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM blocked b JOIN parted p ON b.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (passes + CASE WHEN rest > 0 AND before + size / 2::DOUBLE <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 20
"""

COLLOCATIONS = f"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
words AS (
  SELECT lang, id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM (
    SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
  )
),
after AS (
  SELECT lang, word, lead(word) OVER piece AS second, lead(word, 2) OVER piece AS third
  FROM words WINDOW piece AS (PARTITION BY id ORDER BY place)
),
phrases AS (
  SELECT lang, 1 AS m, word AS phrase FROM after
  UNION ALL SELECT lang, 2, word || ' ' || second FROM after WHERE second IS NOT NULL
  UNION ALL SELECT lang, 3, word || ' ' || second || ' ' || third FROM after WHERE third IS NOT NULL
),
f AS (SELECT lang, m, phrase, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, one.f AS l, two.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (one.f::HUGEINT * two.f) AS BIGINT) AS score
  FROM candidates c JOIN (VALUES (1), (2)) places(k) ON k < c.m
  JOIN f one ON one.lang = c.lang AND one.phrase = array_to_string(c.w[:k], ' ')
  JOIN f two ON two.lang = c.lang AND two.phrase = array_to_string(c.w[k + 1:], ' ')
),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
longer AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[:2], ' ') AS phrase FROM candidates WHERE m = 3
    UNION ALL SELECT lang, a, array_to_string(w[2:], ' ') FROM candidates WHERE m = 3
  ) GROUP BY lang, phrase
),
ranked AS (
  SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank,
    w.phrase, a, l, r, n, score
  FROM weakest w JOIN totals USING (lang) LEFT JOIN longer o ON o.lang = w.lang AND o.phrase = w.phrase
  WHERE NOT coalesce(100 * longer >= 50 * a, false)
)
SELECT * FROM ranked WHERE rank <= 2000
"""



def _nearest(entries: str) -> str:
    """Part rows with their nearest entry, ties to the lower index."""
    return f"""
  SELECT p.row, p.part, p.x, min((list_sum(list_transform(list_zip(p.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
    e.entry)) AS best
  FROM parts p JOIN {entries} e USING (part) GROUP BY p.row, p.part, p.x"""


def _codes(rounds: int) -> str:
    """Rounds written out one after the other, each from the entries before it."""
    text = """
WITH kept AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
numbers AS (
  SELECT row, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM kept
),
parts AS MATERIALIZED (
  SELECT row, part, x[part * (len(x) // 8) + 1:(part + 1) * (len(x) // 8)] AS x
  FROM numbers, (SELECT unnest(range(8)) AS part)
),
entries0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM parts WHERE row <= 16)"""
    for i in range(rounds):
        text += f""",
nearest{i} AS ({_nearest(f"entries{i}")}),
sums{i} AS (
  SELECT part, entry, list(CAST((s - ((s % c) + c) % c) // c AS BIGINT) ORDER BY place) AS x FROM (
    SELECT part, best[2] AS entry, place, sum(v) AS s, count(*) AS c
    FROM (SELECT part, best, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM nearest{i})
    GROUP BY part, best[2], place
  ) GROUP BY part, entry
),
entries{i + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, coalesce(s.x, e.x) AS x FROM entries{i} e LEFT JOIN sums{i} s USING (part, entry)
)"""
    return f"""{text},
found AS ({_nearest(f"entries{rounds}")}),
codes AS (
  SELECT row, string_agg(format('{{:02x}}', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM found GROUP BY row
),
book AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM entries{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row), book
"""


SQL: dict[str, str] = {
    "op2_chat": CHAT,
    "op4_warc": ARCHIVES,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op6_repeats": REPEATS,
    "op8_mixing": MIXING,
    "op9_top_k": TOP_K,
    "op11_collocations": COLLOCATIONS,
    "op12_vector_codes": _codes(6),
}
