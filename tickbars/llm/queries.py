"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from tickbars.llm.chat import op10_chat
from tickbars.llm.decontamination import op5_decontamination
from tickbars.llm.extraction import op8_extraction
from tickbars.llm.fill_in_middle import op13_fill_in_middle
from tickbars.llm.fingerprints import op1_fingerprints
from tickbars.llm.language import op7_language
from tickbars.llm.manifest import op11_manifest
from tickbars.llm.ngram_join import op9_ngram_join
from tickbars.llm.packing import op3_packing
from tickbars.llm.substrings import op2_substrings
from tickbars.llm.suffixes import op12_suffixes
from tickbars.llm.token_counts import op4_token_counts
from tickbars.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_substrings": op2_substrings,
    "op3_packing": op3_packing,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_extraction": op8_extraction,
    "op9_ngram_join": op9_ngram_join,
    "op10_chat": op10_chat,
    "op11_manifest": op11_manifest,
    "op12_suffixes": op12_suffixes,
    "op13_fill_in_middle": op13_fill_in_middle,
}

# The format's length: texts and roles with their escapes, and the marks around and between them.
CHAT_SQL = """
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), known AS (
    SELECT *,
        length(text) + length(regexp_replace(text, '[^\\\\<|]', '', 'g')) AS text_size,
        length(role) + length(regexp_replace(role, '[^\\\\<|]', '', 'g')) AS role_size,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS opens
    FROM given
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(text_size + CASE WHEN opens THEN role_size + 4 + 7 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM known GROUP BY conv_id
"""

# Windows of 13 words (or a whole shorter item) in documents, by exact lists of words.
CONTAMINATION_SQL = r"""
WITH lower_case AS (
    SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lower_case
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item_id, size, list_slice(w, place, place + size - 1) AS win
    FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS place FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
    SELECT doc_id, size, place, list_slice(w, place, place + size - 1) AS win
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM words, sizes WHERE len(w) >= size)
), hits AS (
    SELECT doc_id, place, d.size, item_id FROM doc_windows d JOIN item_windows i ON d.size = i.size AND d.win = i.win
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(place, place + size)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT words.doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""

# Trees as lists of digests, level by level; the crc32 bit by bit.
MANIFEST_SQL = """
WITH RECURSIVE sources AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)
), fields AS (
    SELECT s.tree, d.doc_id, d.text,
        coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || CAST(d.doc_id AS VARCHAR), '-')
        || coalesce(strlen(d.source) || ':' || d.source, '-')
        || coalesce(strlen(d.lang) || ':' || d.lang, '-')
        || coalesce(strlen(CAST(d.n_chars AS VARCHAR)) || ':' || CAST(d.n_chars AS VARCHAR), '-') AS head,
        list_transform(range(1, length(CAST(d.doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(d.doc_id AS VARCHAR), i, 1)) AS BIGINT)) AS digits
    FROM documents d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), checked AS (
    SELECT *, xor(list_reduce(list_concat([4294967295], digits), lambda c, d: list_reduce(list_concat([xor(c, d)], range(8)),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS crc
    FROM fields
), leaves AS (
    SELECT tree, doc_id, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx,
        sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN crc % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
            ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS found
    FROM checked
), levels AS (
    SELECT tree, 0 AS level, list(leaf ORDER BY idx) AS nodes FROM leaves GROUP BY tree
    UNION ALL
    SELECT tree, level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(list_aggregate(nodes[3 * i + 1 : 3 * i + 3], 'string_agg', '')))
    FROM levels WHERE len(nodes) > 1
), subroots AS (
    SELECT tree, nodes[1] AS subroot, level AS height FROM levels WHERE len(nodes) = 1
), tops AS (
    SELECT 0 AS level, list(subroot ORDER BY tree) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(list_aggregate(nodes[3 * i + 1 : 3 * i + 3], 'string_agg', '')))
    FROM tops WHERE len(nodes) > 1
), steps AS (
    SELECT doc_id, l.level AS step, l.nodes, idx // CAST(3 ** l.level AS BIGINT) AS place
    FROM leaves JOIN levels l USING (tree) WHERE len(l.nodes) > 1
    UNION ALL
    SELECT doc_id, height + t.level, t.nodes, tree // CAST(3 ** t.level AS BIGINT)
    FROM leaves JOIN subroots USING (tree), tops t WHERE len(t.nodes) > 1
), around AS (
    SELECT doc_id, step, coalesce(list_aggregate(nodes[place // 3 * 3 + 1 : place], 'string_agg', ''), '') AS before,
        coalesce(list_aggregate(nodes[place + 2 : place // 3 * 3 + 3], 'string_agg', ''), '') AS behind
    FROM steps
), folded AS (
    SELECT doc_id, 0 AS step, found AS digest FROM leaves
    UNION ALL
    SELECT f.doc_id, f.step + 1, sha256(a.before || f.digest || a.behind) FROM folded f JOIN around a ON f.doc_id = a.doc_id AND f.step = a.step
), ends AS (
    SELECT doc_id, arg_max(digest, step) AS folded_root FROM folded GROUP BY doc_id
), proofs AS (
    SELECT doc_id, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof_sha256 FROM around GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, s.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
    coalesce(p.proof_sha256, sha256('')) AS proof_sha256, e.folded_root,
    e.folded_root = (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN ends e USING (doc_id) LEFT JOIN proofs p USING (doc_id)
"""

# Every string of 100 bytes, and the hex digits between those that go.
SUFFIXES_SQL = """
WITH given AS (
    SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS digits FROM documents
), starts AS (
    SELECT doc_id, b, unnest(range(0, octet_length(b) - 99)) AS s FROM given
), strings AS (
    SELECT doc_id, s, row_number() OVER (PARTITION BY b[s + 1 : s + 100] ORDER BY doc_id, s) AS place FROM starts
), later AS (
    SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS opens FROM strings WHERE place > 1
), spans AS (
    SELECT doc_id, min(s) AS a, max(s) + 100 AS z
    FROM (SELECT doc_id, s, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM later) GROUP BY doc_id, span
), gaps AS (
    SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last FROM spans
), kept AS (
    SELECT g.doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
        string_agg(substr(digits, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS head
    FROM gaps g JOIN given USING (doc_id) GROUP BY g.doc_id
)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(head, '') || substr(digits, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM given LEFT JOIN kept USING (doc_id)
"""

MIDDLE_SQL = """
WITH numbers AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
    FROM documents
), cuts AS (
    SELECT doc_id, t, n, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS two,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT doc_id, t, n, form, least(one, two) AS a, greatest(one, two) AS b FROM cuts
), cut AS (
    SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM parts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM cut
"""

ORACLE_SQL = {
    "op5_decontamination": CONTAMINATION_SQL,
    "op10_chat": CHAT_SQL,
    "op11_manifest": MANIFEST_SQL,
    "op12_suffixes": SUFFIXES_SQL,
    "op13_fill_in_middle": MIDDLE_SQL,
}
