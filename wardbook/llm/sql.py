"""DuckDB SQL of the queries that SQL can express, over whole tables and whole texts.

Left out: op1 (DuckDB has no XXH64), op2 (a tokenizer), op4, op6, op7 and op10 (trained models). The tests hold those against brute force.
"""

from __future__ import annotations

from wardbook.llm.licenses import TEMPLATES, words

OP3 = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hexed FROM pages
), shared AS (
    SELECT payload, count(*) AS n, max(page_id) AS last_id FROM payloads GROUP BY payload
)
SELECT page_id,
       octet_length(payload) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(hexed, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN n > 1 AND last_id IS NOT NULL AND page_id IS DISTINCT FROM last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
FROM payloads JOIN shared USING (payload)
"""

OP5 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS id, doc_id, encode(coalesce(text, '')) AS raw, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT id, i, md5(raw[i : i + 399]) AS window_hash FROM texts, unnest(range(1, octet_length(raw) - 398)) AS u(i)
), repeated AS (
    SELECT id, i FROM starts WHERE window_hash IN (SELECT window_hash FROM starts GROUP BY window_hash HAVING count(*) > 1)
), marked AS (
    SELECT id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY id ORDER BY i) + 400 THEN 0 ELSE 1 END AS opens FROM repeated
), numbered AS (
    SELECT id, i, sum(opens) OVER (PARTITION BY id ORDER BY i) AS span FROM marked
), spans AS (
    SELECT id, min(i) AS first, max(i) + 400 AS after FROM numbered GROUP BY id, span
), kept AS (
    SELECT t.id, coalesce(lag(s.after) OVER (PARTITION BY t.id ORDER BY s.first), 1) AS begins, s.first - 1 AS ends, t.raw
    FROM texts t JOIN spans s ON s.id = t.id
    UNION ALL
    SELECT t.id, max(s.after), octet_length(t.raw), t.raw FROM texts t JOIN spans s ON s.id = t.id GROUP BY t.id, t.raw
), rest AS (
    SELECT id, unhex(string_agg(CASE WHEN ends >= begins THEN hex(raw[begins : ends]) ELSE '' END, '' ORDER BY begins)) AS left_over FROM kept GROUP BY id
), counted AS (
    SELECT id, sum(after - first) AS n_removed, count(*) AS n_spans FROM spans GROUP BY id
), passages AS (
    SELECT id, i, md5(array_to_string(w[i : i + 50], ' ')) AS passage_hash FROM texts, unnest(range(1, len(w) - 49)) AS u(i)
), again AS (
    SELECT id, i FROM passages WHERE passage_hash IN (SELECT passage_hash FROM passages GROUP BY passage_hash HAVING count(*) > 1)
), steps AS (
    SELECT id, least(51, coalesce(i - lag(i) OVER (PARTITION BY id ORDER BY i), 51)) AS added FROM again
), worded AS (
    SELECT id, sum(added) AS n_repeated_words FROM steps GROUP BY id
)
SELECT doc_id,
       octet_length(raw) AS n_bytes,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(left_over, raw)) AS kept_sha256,
       coalesce(n_repeated_words, 0)::BIGINT AS n_repeated_words
FROM texts LEFT JOIN counted USING (id) LEFT JOIN rest USING (id) LEFT JOIN worded USING (id)
"""

OP8 = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), sized AS (
    SELECT item_id, w, least(len(w), 10) AS size FROM item_words WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS string FROM sized, unnest(range(1, len(w) - size + 2)) AS u(i)
), doc_words AS (
    SELECT row_number() OVER () AS id, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), doc_windows AS (
    SELECT id, i, size, array_to_string(w[i : i + size - 1], ' ') AS string
    FROM doc_words, (SELECT DISTINCT size FROM windows), unnest(range(1, len(w) - size + 2)) AS u(i)
), found AS (
    SELECT id, i, size, item_id FROM doc_windows JOIN windows USING (size, string)
), hit AS (
    SELECT id, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, size)) AS u(k) GROUP BY id
), named AS (
    SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY id
)
SELECT doc_id,
       len(w) AS n_words,
       coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (id) LEFT JOIN named USING (id)
"""

OP9 = """
WITH placed AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place,
           md5(coalesce('r' || role, '-')) || md5(coalesce('t' || text, '-')) AS one
    FROM conversations
), prefixes AS (
    SELECT conv_id, place, md5(string_agg(one, '') OVER (PARTITION BY conv_id ORDER BY place)) AS upto, count(*) OVER (PARTITION BY conv_id) AS n_turns
    FROM placed
), ends AS (
    SELECT upto, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM prefixes WHERE place = n_turns GROUP BY upto, n_turns
), kept AS (
    SELECT * FROM ends WHERE upto NOT IN (SELECT upto FROM prefixes WHERE place < n_turns)
)
SELECT k.conv_id, k.n_turns, k.n_copies,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
FROM kept k JOIN placed p ON p.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY k.conv_id, k.n_turns, k.n_copies
"""

_NOTICES = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
_STEP = max(len(words(text.encode())) for _, text in TEMPLATES)


def _words_of(text: str) -> str:
    return f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


OP12 = f"""
WITH texts AS (
    SELECT row_number() OVER () AS id, doc_id, {_words_of("coalesce(text, '')")} AS w FROM documents
), places AS (
    SELECT id, unnest(range(0, len(w))) AS p, unnest(w) AS word, unnest(w[2:] || [NULL]) AS second, unnest(w[3:] || [NULL, NULL]) AS third FROM texts WHERE len(w) > 0
), base AS (
    SELECT id, p, 'cc-by' AS label FROM places WHERE word = 'cc' AND second = 'by'
    UNION ALL SELECT id, p, 'gpl' FROM places WHERE word = 'general' AND second = 'public' AND third = 'license'
    UNION ALL SELECT id, p, 'reserved' FROM places WHERE word = 'all' AND second = 'rights' AND third = 'reserved'
), notices AS (
    SELECT n, label, {_words_of("text")} AS w FROM (VALUES {_NOTICES}) AS t(n, label, text)
), pairs AS (
    SELECT DISTINCT n, label, a || ' ' || b AS pair FROM (SELECT n, label, unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM notices)
), sizes AS (
    SELECT n, count(*) AS size FROM pairs GROUP BY n
), blocks AS (
    SELECT id, n, label, block, count(DISTINCT pair) AS common
    FROM places JOIN pairs ON pair = word || ' ' || second, unnest([p // {_STEP}, p // {_STEP} - 1]) AS u(block)
    WHERE block >= 0 AND p + 1 < (block + 2) * {_STEP}
    GROUP BY id, n, label, block
), found AS (
    SELECT id, label, common / size AS share FROM blocks JOIN sizes USING (n) WHERE common >= ceil(0.8 * size - 1e-9)
), summed AS (
    SELECT id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY id
), listed AS (
    SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT id, label FROM base UNION ALL SELECT id, label FROM found) GROUP BY id
), most AS (
    SELECT id, max(share) AS share FROM found GROUP BY id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM texts LEFT JOIN summed USING (id) LEFT JOIN listed USING (id) LEFT JOIN most USING (id)
"""

OP13 = """
WITH taking_part AS (
    SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END)::BIGINT AS label,
           list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
    FROM (SELECT DISTINCT * FROM taking_part WHERE vec_id % 100 = 0) AS a JOIN taking_part AS r ON r.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, row_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) AS positive_rank
    FROM scores WHERE same
), ranked AS (
    SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_rank ORDER BY score DESC, row_id) AS rank,
           row_id AS negative_id, positive_score, score AS negative_score, positive_rank
    FROM positives AS p JOIN scores AS s ON s.anchor_id = p.anchor_id AND NOT same
    WHERE positive_rank <= 5 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score, positive_rank
FROM ranked WHERE rank <= 10
"""

SQL = {"op3_warc": OP3, "op5_suffix_dedup": OP5, "op8_decontaminate": OP8, "op9_chats": OP9, "op12_licenses": OP12, "op13_hard_negatives": OP13}
