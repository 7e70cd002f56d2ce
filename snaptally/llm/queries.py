"""Registered queries of the training-data operators, and their DuckDB statements
where SQL can express them."""

from __future__ import annotations

from .bpe import op9_bpe
from .count_vector_join import op4_ngram_jaccard_join
from .fill_in_middle import op13_fill_in_middle
from .language_filter import op7_language_id
from .mixing import op3_pfair_mix
from .page_wrappers import op12_html_extraction
from .personal_data import op6_personal_data
from .projection_passes import op10_embedding_near_dedup
from .quality import op1_quality_rules
from .recompression import op8_substring_recompression
from .secrets import op2_secret_forest
from .suffix_dedup import op5_suffix_array_dedup
from .token_alignment import op11_token_alignment

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_secret_forest,
        op3_pfair_mix,
        op4_ngram_jaccard_join,
        op5_suffix_array_dedup,
        op6_personal_data,
        op7_language_id,
        op8_substring_recompression,
        op9_bpe,
        op10_embedding_near_dedup,
        op11_token_alignment,
        op12_html_extraction,
        op13_fill_in_middle,
    )
}

_WORDS = r"[^\x20\x09-\x0D]+"

_OP4 = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}'), []) AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 3), ' ')) AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM t WHERE len(w) > 0) u),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (
  SELECT a AS node, a AS other FROM link UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       CAST(coalesce((SELECT min(other) FROM reach WHERE node = t.doc_id), t.doc_id) AS BIGINT) AS component_id
FROM t LEFT JOIN n ON n.doc_id = t.doc_id"""

_OP8 = rf"""
WITH t AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORDS}'), []) AS w FROM documents),
p AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS word FROM t),
s AS (
  SELECT doc_id, unnest(range(len(w) - 49)) AS p,
         unnest(list_transform(range(len(w) - 49), lambda i: md5(array_to_string(list_slice(w, i + 1, i + 50), ' ')))) AS x
  FROM t WHERE len(w) >= 50),
f AS (SELECT doc_id, p, doc_id > min(doc_id) OVER (PARTITION BY x) AS seen FROM s),
g AS (
  SELECT p.doc_id, p.p, p.word,
         coalesce(max(CASE WHEN seen THEN f.p END) OVER (PARTITION BY p.doc_id ORDER BY p.p) > p.p - 50, false) AS gone
  FROM p LEFT JOIN f ON f.doc_id = p.doc_id AND f.p = p.p),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM g),
k AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM e GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM t LEFT JOIN k ON k.doc_id = t.doc_id"""

_OP10 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT a AS node, a AS other FROM link UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.other),
c AS (SELECT v.vec_id, coalesce((SELECT min(other) FROM reach WHERE node = v.vec_id), v.vec_id) AS component_id FROM v)
SELECT vec_id, CAST((SELECT count(*) FROM link WHERE a = vec_id) AS BIGINT) AS n_links,
       CAST(component_id AS BIGINT) AS component_id, vec_id = component_id AS kept
FROM c"""

_OP13 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), []) AS u,
         sha256('42:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents),
r AS (SELECT *, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS d, len(u) AS n FROM t),
c AS (SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b FROM r),
f AS (
  SELECT doc_id, n, text,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 50 THEN 'plain'
              WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, b), '') AS m, array_to_string(list_slice(u, b + 1, n), '') AS s
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM f"""

#: Where SQL can express the whole result in reasonable time: 100-byte windows of op5 took
#: DuckDB more than 100 s at sf0.01. The others are tested against direct versions.
ORACLE_SQL: dict[str, str] = {
    "op4_ngram_jaccard_join": _OP4,
    "op8_substring_recompression": _OP8,
    "op10_embedding_near_dedup": _OP10,
    "op13_fill_in_middle": _OP13,
}
