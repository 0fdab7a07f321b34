"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

from registry.sql import CRC_TABLE, crc32

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES = {
    "op1_decontaminate": rf"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
),
sized AS (SELECT item_id, ws, least(len(ws), 10) AS size FROM items WHERE len(ws) > 0),
item_places AS (SELECT item_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM sized),
item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(ws[i : i + size - 1], ' ') AS run FROM item_places
),
doc_places AS (
    SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
    FROM docs, (SELECT DISTINCT size FROM sized) AS sizes WHERE len(ws) >= size
),
doc_windows AS (SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS run FROM doc_places),
hits AS (
    SELECT d.doc_id, d.i, d.size, w.item_id FROM doc_windows AS d JOIN item_windows AS w USING (size, run)
),
hit_places AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM hits),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM hit_places GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT
    docs.doc_id,
    CAST(len(ws) AS BIGINT) AS n_words,
    coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items,
    coalesce(digest, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""",
    "op2_chat": r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, length(regexp_replace(text, '(<|\[)(\\*)(/?s>|</?SYS>>|/?INST\])', '\1\\\2\3', 'g')) AS n FROM rows
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(3 + length(role) + 1 + n + 4) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op3_suffix": r"""
WITH docs AS (
    SELECT doc_id, encode(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents
),
places AS (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM docs WHERE n >= 50),
strings AS (SELECT doc_id, i, h[i + 1 : i + 50] AS s FROM places),
firsts AS (SELECT s, min(doc_id) AS low FROM strings GROUP BY s),
hits AS (SELECT doc_id, i FROM strings JOIN firsts USING (s) WHERE doc_id > low),
steps AS (
    SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, TRUE) AS fresh FROM hits
),
islands AS (SELECT doc_id, i, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM steps),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM islands GROUP BY doc_id, island),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
cut AS (
    SELECT
        doc_id,
        CAST(sum(b - a) AS BIGINT) AS n_removed,
        count(*) AS n_spans,
        string_agg(hex(h[before + 1 : a]), '' ORDER BY a) AS head,
        max(b) AS last
    FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT
    doc_id,
    n AS n_bytes,
    coalesce(n_removed, 0) AS n_removed,
    coalesce(n_spans, 0) AS n_spans,
    sha256(CASE WHEN last IS NULL THEN h ELSE unhex(head || hex(h[last + 1 :])) END) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
""",
    "op4_lines": rf"""
WITH lines AS (
    SELECT
        doc_id,
        unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS unit
    FROM documents
),
placed AS (
    SELECT
        doc_id,
        unit,
        line,
        coalesce(sum(length(line) + 1) OVER (
            PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0) AS line_start
    FROM lines
),
pieces AS (
    SELECT doc_id, unit, line_start, unnest(cut) AS piece, generate_subscripts(cut, 1) AS i, len(cut) AS n
    FROM (
        SELECT *, string_split(regexp_replace(line, '([.!?][ \t]+)', '\1' || chr(63743), 'g'), chr(63743)) AS cut FROM placed
    )
),
sentences AS (
    SELECT
        doc_id,
        unit,
        i,
        line_start + coalesce(sum(length(piece)) OVER (
            PARTITION BY doc_id, unit ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0) AS span_start,
        CASE WHEN i = n THEN piece ELSE rtrim(piece, ' ' || chr(9)) END AS body
    FROM pieces
),
bodies AS (
    SELECT doc_id, unit, 0 AS i, line_start AS span_start, line AS body FROM placed
    UNION ALL SELECT doc_id, unit, i, span_start, body FROM sentences
),
normal AS (
    SELECT
        doc_id,
        unit,
        i,
        span_start,
        length(body) AS n,
        trim(regexp_replace(translate(body, {LOWER}), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
    FROM bodies
),
counted AS (
    SELECT
        *,
        len(string_split(norm, ' ')) AS n_words,
        row_number() OVER (PARTITION BY doc_id, unit ORDER BY i) - 1 AS part,
        count(*) OVER (PARTITION BY doc_id, unit) - 1 AS n_parts
    FROM normal WHERE norm <> ''
),
ranked AS (
    SELECT
        *,
        row_number() OVER same AS place,
        first_value(doc_id) OVER same AS keep_id,
        first_value(unit) OVER same AS keep_unit,
        first_value(part) OVER same AS keep_part
    FROM counted WHERE part = 0 OR n_parts > 1 AND n_words >= 8
    WINDOW same AS (PARTITION BY norm ORDER BY doc_id, unit, part)
),
removed AS (SELECT * FROM ranked WHERE place > 1)
SELECT
    doc_id,
    CAST(unit AS INTEGER) AS unit,
    CAST(part AS INTEGER) AS part,
    CAST(span_start AS BIGINT) AS span_start,
    CAST(span_start + n AS BIGINT) AS span_end,
    CAST(n_words AS INTEGER) AS n_words,
    md5(norm) AS digest,
    keep_id,
    CAST(keep_unit AS INTEGER) AS keep_unit,
    CAST(keep_part AS INTEGER) AS keep_part
FROM removed AS r
WHERE part = 0 OR NOT EXISTS (
    SELECT 1 FROM removed AS w WHERE w.part = 0 AND w.doc_id = r.doc_id AND w.unit = r.unit
)
""",
    "op9_chunks": r"""
WITH lines AS (
    SELECT
        doc_id,
        unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS k
    FROM documents
),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines),
rolled AS (
    SELECT
        *,
        h + 31 * lag(h, 1, 0) OVER doc + 961 * lag(h, 2, 0) OVER doc AS rolling,
        coalesce(sum(length(line) + 1) OVER (doc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS began
    FROM hashed
    WINDOW doc AS (PARTITION BY doc_id ORDER BY k)
),
flagged AS (
    SELECT *, rolling % 1000003 % 4 = 0 OR coalesce(rolling = lag(rolling, 1) OVER doc, FALSE)
        OR coalesce(rolling = lag(rolling, 2) OVER doc, FALSE) AS ends
    FROM rolled
    WINDOW doc AS (PARTITION BY doc_id ORDER BY k)
),
-- Places behind which a chunk ends: flagged ones at least two lines behind the last such place.
cuts AS (
    SELECT doc_id, list_reduce(list_prepend([CAST(0 AS BIGINT)], list([k + 1] ORDER BY k) FILTER (ends)),
        lambda seen, place: CASE WHEN place[1] - seen[-1] >= 2 THEN list_concat(seen, place) ELSE seen END) AS places
    FROM flagged GROUP BY doc_id
),
numbered AS (
    SELECT f.*, CASE WHEN places IS NULL THEN 0 ELSE len(list_filter(places, lambda p: p <= k)) - 1 END AS chunk
    FROM flagged AS f JOIN cuts USING (doc_id)
),
chunks AS (
    SELECT
        doc_id, chunk, min(k) AS line, count(*) AS n_lines, min(began) AS span_start,
        string_agg(line, chr(10) ORDER BY k) AS piece
    FROM numbered GROUP BY doc_id, chunk HAVING count(*) >= 2
),
ranked AS (
    SELECT
        *,
        row_number() OVER same AS place,
        first_value(doc_id) OVER same AS keep_id,
        first_value(chunk) OVER same AS keep_chunk
    FROM chunks WINDOW same AS (PARTITION BY piece ORDER BY doc_id, chunk)
)
SELECT
    doc_id,
    CAST(chunk AS INTEGER) AS chunk,
    CAST(line AS INTEGER) AS line,
    CAST(n_lines AS INTEGER) AS n_lines,
    CAST(span_start AS BIGINT) AS span_start,
    CAST(span_start + length(piece) AS BIGINT) AS span_end,
    keep_id,
    CAST(keep_chunk AS INTEGER) AS keep_chunk
FROM ranked WHERE place > 1
""",
    "op10_exact": r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT
    doc_id,
    min(doc_id) OVER same AS keep_id,
    count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept,
    sha256(norm) AS text_sha256
FROM d
WINDOW same AS (PARTITION BY norm)
""",
    "op11_spelling": rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (
    SELECT doc_id, word, count(*) AS n
    FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, {LOWER}), '[a-zÀ-ÿ]+')) AS word FROM documents
    )
    WHERE length(word) >= 6 GROUP BY doc_id, word
),
marked AS (
    SELECT word, n, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word")} AS h FROM runs, crc
),
damaged AS (
    SELECT CASE WHEN h % 199 = 0
        THEN substr(word, 1, h % length(word)) || substr(word, (h % length(word)) + 2) ELSE word END AS word, n
    FROM marked
),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
places AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM words),
skips AS (
    SELECT word, n, substr(word, 1, i) || '_' || substr(word, i + 2) AS mask,
        substr(word, 1, i) || substr(word, i + 2) AS shorter
    FROM places
),
deleted AS (
    SELECT DISTINCT s.word AS long_word, s.n AS long_n, w.word AS short_word, w.n AS short_n
    FROM skips AS s JOIN words AS w ON s.shorter = w.word
),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM skips AS a JOIN skips AS b USING (mask) WHERE a.word <> b.word
    UNION ALL SELECT long_word, short_word, short_n FROM deleted
    UNION ALL SELECT short_word, long_word, long_n FROM deleted
),
best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM near GROUP BY word
),
forms AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
named AS (
    SELECT f.word, min(other) AS form FROM forms AS f JOIN near ON near.word = f.word AND near.other_n = f.form_n
    GROUP BY f.word
),
followed AS (
    SELECT word, word AS root FROM words
    UNION SELECT followed.word, named.form FROM followed JOIN named ON named.word = followed.root
),
rooted AS (SELECT word, root FROM followed WHERE root NOT IN (SELECT word FROM named))
SELECT forms.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM forms LEFT JOIN named USING (word) JOIN rooted USING (word)
""",
    "op12_prefix_trie": rf"""
WITH crc AS ({CRC_TABLE}),
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, {crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc
),
placed AS (
    SELECT c.conv_id, pos, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id - c.conv_id % 100
    WHERE pos < h
    UNION ALL SELECT c.conv_id, pos, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id WHERE pos >= h
),
said AS (
    SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY pos) AS path,
        list(length(text) ORDER BY pos) AS chars
    FROM placed GROUP BY conv_id
),
lists AS (SELECT conv_id, coalesce(path, []) AS path, coalesce(chars, []) AS chars FROM convs LEFT JOIN said USING (conv_id)),
steps AS (
    SELECT conv_id, d, array_to_string(path[1 : d], '|') AS node,
        CASE WHEN d > 0 THEN array_to_string(path[1 : d - 1], '|') END AS parent, len(path) = d AS ends,
        CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
    FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM lists)
),
nodes AS (
    SELECT node, min(d) AS depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * min(chars) AS saved, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids
    FROM steps GROUP BY node
),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
    SELECT s.node, sum(CASE WHEN k.node IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved_tokens
    FROM nodes AS n JOIN steps AS s ON s.conv_id = n.conv_id AND s.d <= n.depth LEFT JOIN children AS k ON k.node = n.node
    GROUP BY s.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
    sha256(coalesce(n.ids, '')) AS ends_sha256
FROM nodes AS n LEFT JOIN nodes AS p ON p.node = n.parent LEFT JOIN children AS k ON k.node = n.node
JOIN sums ON sums.node = n.node
""",
}
