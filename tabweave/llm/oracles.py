"""The same results in DuckDB SQL, where SQL can say them."""

from __future__ import annotations

SQL: dict[str, str] = {}

_SPACES = r"[\x20\x09-\x0D]+"

SQL["op7_exact_dedup"] = rf"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY t)
"""

# Formatted parts are 12 + role + 1 + escaped text + 11 characters long; an example ends with its turn.
SQL["op9_chat_format"] = """
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), parts AS (
  SELECT *, sum(24 + length(role) + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))) OVER (
           PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS ending,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_last
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(ending) FILTER (WHERE role = 'assistant' OR from_last = 1) AS BIGINT) AS formatted_chars
FROM parts GROUP BY conv_id
"""

# Texts as hexadecimal digits, two per byte, so that positions are those of bytes.
SQL["op10_repeated_spans"] = """
WITH given AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(length(hex(encode(coalesce(text, '')))) // 2 AS BIGINT) AS n FROM documents
), strings AS (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 199, 0))) AS i FROM given)
), repeated AS (
  SELECT s FROM strings GROUP BY s HAVING count(*) > 1
), places AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS previous FROM strings SEMI JOIN repeated USING (s)
), numbered AS (
  SELECT doc_id, i, sum(CASE WHEN previous IS NULL OR i > previous + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span
  FROM places
), spans AS (
  SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, span
), pieces AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS previous FROM spans
), cut AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * previous + 1, 2 * (a - previous)), '' ORDER BY a) AS head, max(b) AS ending
  FROM pieces JOIN given USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN ending IS NULL THEN h ELSE head || substr(h, 2 * ending + 1) END)) AS kept_sha256
FROM given LEFT JOIN cut USING (doc_id)
"""


def _codebook_round(n: int) -> str:
    """Assign every part to its nearest entry of ``book{n}``, and move the entries to ``book{n + 1}``."""
    return f"""
near{n} AS MATERIALIZED (
  SELECT vec_id, part, min(square * 64 + entry) % 64 AS entry, min(square * 64 + entry) // 64 AS square
  FROM (SELECT c.vec_id, c.part, b.entry,
               CAST(list_sum(list_transform(list_zip(c.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS square
        FROM cut c JOIN book{n} b USING (part))
  GROUP BY vec_id, part
), moved{n} AS (
  SELECT part, entry, list(mean ORDER BY place) AS v
  FROM (SELECT part, entry, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
        FROM (SELECT c.part, a.entry, unnest(c.v) AS x, generate_subscripts(c.v, 1) AS place
              FROM cut c JOIN near{n} a USING (vec_id, part))
        GROUP BY part, entry, place)
  GROUP BY part, entry
), book{n + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN moved{n} m USING (part, entry)
)"""


SQL["op12_vector_codes"] = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS v FROM kept, range(16) t(part)
), book0 AS MATERIALIZED (
  SELECT part, entry, v
  FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM cut) WHERE entry < 64
), {_codebook_round(0)}, {_codebook_round(1)}, {_codebook_round(2)}, coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(square) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""

# The CRC-32 of a word byte by byte, from its hexadecimal digits and the table of its polynomial.
SQL["op13_resampling"] = """
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS crcs
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i:
                 CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(b))
), words AS (
  SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents
), target_words AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark
), features AS (
  SELECT doc_id, unnest(w) AS word FROM words
), counted AS (
  SELECT word, sum(s) AS s, sum(t) AS t
  FROM (SELECT word, count(*) AS s, 0 AS t FROM features GROUP BY word
        UNION ALL SELECT word, 0, count(*) FROM target_words GROUP BY word)
  GROUP BY word
), hexed AS (
  SELECT word, s, t, hex(encode(word)) AS h FROM counted
), hashed AS MATERIALIZED (
  SELECT word, s, t, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(range(length(h) // 2), lambda i:
             (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1)),
           lambda c, b: xor(crcs[xor(c & 255, b) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM hexed, crc_table
), buckets AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket
), totals AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM buckets
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (s_all + 10000) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM buckets, totals
), weights AS (
  SELECT doc_id, sum(gain) AS weight FROM features JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""
