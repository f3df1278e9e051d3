"""SQL twins of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

#: Cosine in doubles; components by reachability.
OP1 = """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v), l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.93),
 r AS (SELECT a AS x, a AS c FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.x), k AS (SELECT x, min(c) AS c FROM r GROUP BY 1), n AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
 SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(k.c, e.vec_id) AS component_id, coalesce(k.c, e.vec_id) = e.vec_id AS kept FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN k ON k.x = e.vec_id"""

#: Base counts by positions of three-word windows; a host's lines counted by distinct documents, a document being its set of lines.
OP3 = r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
 g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w), h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM g), p AS (SELECT doc_id, count(*) AS r FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM h WHERE n > 1) GROUP BY 1),
 l AS (SELECT doc_id, host, unnest(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS x FROM d), dup AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM l GROUP BY 1),
 f AS (SELECT DISTINCT doc_id, host, trim(regexp_replace(regexp_replace(lower(x), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g')) AS x FROM l), a AS (SELECT doc_id, sum(length(x))::BIGINT AS line_chars, list_sort(list(x)) AS doc FROM f GROUP BY 1),
 q AS (SELECT host, x FROM f JOIN a ON a.doc_id = f.doc_id GROUP BY 1, 2 HAVING count(DISTINCT doc) > 20), k AS (SELECT f.doc_id, count(*) AS n, sum(length(f.x))::BIGINT AS chars FROM f JOIN q ON q.host = f.host AND q.x = f.x GROUP BY 1),
 b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, coalesce(k.n, 0) AS n_frequent_lines, coalesce(line_chars, 0) - coalesce(k.chars, 0) AS left_chars, coalesce(line_chars, 0) AS line_chars
 FROM d JOIN w ON w.doc_id = d.doc_id LEFT JOIN dup ON dup.doc_id = d.doc_id LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN a ON a.doc_id = d.doc_id), c AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, left_chars < 0.25 * line_chars AS depleted FROM b)
 SELECT *, NOT base_failed AND NOT depleted AS kept FROM c"""

#: Shared shingles counted by an equi-join on shingles of more than one document.
OP5 = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 m AS (SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY s) AS k FROM s) WHERE k > 1), i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM m a JOIN m b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS (SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b WHERE 100 * i >= 85 * (x.n + y.n - i)), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), r AS (SELECT a AS x, a AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.x), k AS (SELECT x, min(c) AS c FROM r GROUP BY 1)
 SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.c, d.doc_id) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.x = d.doc_id"""

#: Turns as rows; the common prefix ends before the first turn that differs.
OP10 = r"""WITH c AS (SELECT conv_id AS conv, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS i FROM conversations),
 z AS (SELECT conv, count(*) AS n, sum(length(text)) AS chars, max(CASE WHEN i = 1 THEN role || chr(1) || text END) AS opening, max(CASE WHEN role = 'assistant' THEN i END) AS answer FROM c GROUP BY 1),
 b AS (SELECT opening, conv AS chosen, k FROM (SELECT *, row_number() OVER (PARTITION BY opening ORDER BY n DESC, chars DESC, conv NULLS FIRST) AS r, count(*) OVER (PARTITION BY opening) AS k FROM z) WHERE r = 1),
 p AS (SELECT chosen, CASE WHEN z.conv <> chosen THEN z.conv END AS rejected FROM z JOIN b ON b.opening = z.opening WHERE z.conv <> chosen OR k = 1),
 f AS (SELECT p.chosen, p.rejected, min(CASE WHEN y.conv IS NULL OR x.role <> y.role OR x.text <> y.text THEN x.i END) AS differs FROM p JOIN c x ON x.conv = p.chosen LEFT JOIN c y ON y.conv = p.rejected AND y.i = x.i WHERE p.rejected IS NOT NULL GROUP BY 1, 2),
 l AS (SELECT p.chosen, p.rejected, CASE WHEN p.rejected IS NULL THEN coalesce(a.answer - 1, a.n) ELSE coalesce(f.differs - 1, a.n) END AS m FROM p JOIN z a ON a.conv = p.chosen LEFT JOIN f ON f.chosen = p.chosen AND f.rejected = p.rejected),
 t AS (SELECT conv, i, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS s, length('<|' || role || '|>') + 1 AS lead, length(text) + 7 AS len FROM c),
 o AS (SELECT *, coalesce(sum(length(s)) OVER (PARTITION BY conv ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM t),
 x AS (SELECT l.chosen, l.rejected, m, coalesce(string_agg(s, '' ORDER BY i) FILTER (i <= m), '') AS prompt, coalesce(string_agg(s, '' ORDER BY i) FILTER (i > m), '') AS chosen_text, coalesce(string_agg((pos + lead)::BIGINT || ':' || len, ',' ORDER BY i) FILTER (i > m AND role = 'assistant'), '') AS chosen_spans FROM l JOIN o ON o.conv = l.chosen GROUP BY 1, 2, 3),
 y AS (SELECT l.chosen, l.rejected, coalesce(string_agg(s, '' ORDER BY i) FILTER (i > m), '') AS rejected_text, coalesce(string_agg((pos + lead)::BIGINT || ':' || len, ',' ORDER BY i) FILTER (i > m AND role = 'assistant'), '') AS rejected_spans FROM l JOIN o ON o.conv = l.rejected GROUP BY 1, 2)
 SELECT x.chosen, x.rejected, m::BIGINT AS prompt_turns, prompt, chosen_text, y.rejected_text, chosen_spans, y.rejected_spans FROM x LEFT JOIN y ON y.chosen = x.chosen AND y.rejected = x.rejected"""



def _op12(rounds: int = 3) -> str:
    """Every distance of every assignment, in whole numbers; ties to the smaller number by the order of structs."""
    with_ = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
     """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x AS y FROM (SELECT * FROM v ORDER BY sha256('1:' || vec_id), x LIMIT 16))"""]  # fmt: skip
    for r in range(rounds + 1):
        with_.append(f"a{r} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'c': c}}) AS best FROM v, c{r} GROUP BY rid)")
        if r < rounds:
            with_.append(f"s{r} AS (SELECT c, i, sum(z)::BIGINT AS s, count(*) AS n FROM (SELECT best.c AS c, unnest(x) AS z, unnest(range(64)) AS i FROM a{r}) GROUP BY 1, 2)")
            with_.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.y, o.y) AS y FROM c{r} o LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS y FROM s{r} GROUP BY 1) m ON m.c = o.c)")
    return f"""WITH {", ".join(with_)} SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.y, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best.c"""


SQL = {"op1_pq_dedup": OP1, "op3_line_frequency": OP3, "op5_ngram_jaccard": OP5, "op10_preferences": OP10, "op12_elkan": _op12()}
