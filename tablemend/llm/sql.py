"""The queries that SQL can express, as DuckDB runs them."""

from tablemend.llm import line_dedup

_SEEN = "html"
for _pattern in line_dedup.UNSEEN:
    _SEEN = f"regexp_replace({_SEEN}, '{_pattern}', '', 'g')"

SQL: dict[str, str] = {
    "op3_lines": f"""
        WITH p AS (
            SELECT page_id, lower(regexp_extract(url, '{line_dedup.HOST}', 1)) AS host,
                   regexp_replace(regexp_replace({_SEEN}, '{line_dedup.BLOCK_TAG}', chr(10), 'gi'), '{line_dedup.TAG}', '', 'g') AS text
            FROM pages
        ), l AS (
            SELECT page_id, host, line, i
            FROM (SELECT page_id, host, string_split(text, chr(10)) AS lines FROM p),
                 UNNEST(lines) WITH ORDINALITY AS u(line, i)
        ), n AS (
            SELECT host, trim(line) AS line, count(DISTINCT page_id) AS n FROM l WHERE trim(line) <> '' GROUP BY ALL
        ), f AS (
            SELECT n.host, n.line
            FROM n JOIN (SELECT host, count(*) AS pages FROM p GROUP BY host) t ON n.host = t.host
            WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.RATIO}::DOUBLE * pages
        ), j AS (
            SELECT l.*, f.line IS NOT NULL AS dropped
            FROM l LEFT JOIN f ON l.host = f.host AND trim(l.line) = f.line
        )
        SELECT page_id, host, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS text,
               count(*) FILTER (trim(line) <> '') AS n_lines, count(*) FILTER (dropped) AS n_dropped
        FROM j GROUP BY page_id, host
    """,
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, d.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id
        ), r AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n
            FROM s
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
    """,
    "op7_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+'
                   ) AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS shingle
            FROM w, UNNEST(range(1, greatest(len(words) - 2, least(len(words), 1)) + 1)) AS u(i)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ), l AS (
            SELECT p.a, p.b
            FROM p JOIN n na ON p.a = na.doc_id JOIN n nb ON p.b = nb.doc_id
            WHERE 100 * shared >= 90 * (na.n + nb.n - shared)
        ), r AS (
            SELECT doc_id AS id, doc_id AS reached FROM w
            UNION
            SELECT r.id, l.b FROM r JOIN l ON r.reached = l.a
        )
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
        FROM w LEFT JOIN n ON w.doc_id = n.doc_id
        JOIN (SELECT id, min(reached) AS component_id FROM r GROUP BY id) m ON m.id = w.doc_id
    """,
    "op9_substrings": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), n AS (
            SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS passage
            FROM w, UNNEST(range(1, len(words) - 11)) AS u(i)
        ), f AS (
            SELECT passage, min(doc_id) AS first FROM n GROUP BY passage HAVING min(doc_id) < max(doc_id)
        ), d AS (
            SELECT DISTINCT n.doc_id, unnest(range(n.i, n.i + 13)) AS i
            FROM n JOIN f ON n.passage = f.passage AND n.doc_id > f.first
        ), p AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
        ), k AS (
            SELECT p.doc_id, count(*) AS n_words, count(d.i) AS n_removed,
                   string_agg(p.word, ' ' ORDER BY p.i) FILTER (d.i IS NULL) AS kept
            FROM p LEFT JOIN d ON p.doc_id = d.doc_id AND p.i = d.i
            GROUP BY p.doc_id
        )
        SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k ON w.doc_id = k.doc_id
    """,
    "op12_filter_audit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), g AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                   max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ), f AS (
            SELECT w.doc_id, part,
                   CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask,
                   coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM w LEFT JOIN g ON w.doc_id = g.doc_id
        ), c AS (
            SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
        ), b AS (
            SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
        ), o AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
            FROM b a, b b, b c, b d, b e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
        ), s AS (
            SELECT filter_order, step, b.bit,
                   (SELECT coalesce(sum(x.bit), 0) FROM b x WHERE instr(filter_order, x.letter) < step) AS before
            FROM o, UNNEST([1, 2, 3, 4, 5]) AS u(step), b
            WHERE b.letter = filter_order[step]
        ), r AS (
            SELECT part, filter_order, step, s.bit,
                   sum(CASE WHEN mask & bit = 0 AND mask & before::INT = 0 THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN mask & bit > 0 AND mask & before::INT = 0 THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN mask & bit > 0 AND mask & before::INT > 0 THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN mask & bit > 0 AND mask & before::INT = 0 THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN mask & bit > 0 AND mask & before::INT = 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM c, s GROUP BY part, filter_order, step, s.bit
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM r
    """,
    "op13_collocations": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
                   regexp_extract_all(piece, '[^\x20\x09]+') AS words
            FROM documents, UNNEST(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]'
            )) AS u(piece)
        ), n AS (
            SELECT lang, sum(len(words)) AS n FROM d GROUP BY lang
        ), f AS (
            SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS f
            FROM d, UNNEST([1, 2, 3]) AS v(k), UNNEST(range(1, len(words) - k + 2)) AS u(i)
            GROUP BY ALL HAVING count(*) >= 10
        ), g AS (
            SELECT lang || chr(9) || phrase AS id, f FROM f
        ), c AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
        ), h AS (
            SELECT lang, k, phrase, a, cut, lang || chr(9) || array_to_string(w[1 : cut], ' ') AS head,
                   lang || chr(9) || array_to_string(w[cut + 1 :], ' ') AS tail
            FROM c, UNNEST(range(1, k)) AS u(cut)
        ), s AS (
            SELECT h.lang, h.k, h.phrase, h.a, h.cut, x.f AS l, y.f AS r,
                   (1000000::HUGEINT * h.a * h.a) // (x.f::HUGEINT * y.f) AS score
            FROM h JOIN g x ON x.id = h.head JOIN g y ON y.id = h.tail
        ), m AS (
            SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS worst FROM s
        ), b AS (
            SELECT lang, phrase, max(a) AS longer
            FROM (SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase FROM c WHERE k = 3)
            GROUP BY lang, phrase
        ), o AS (
            SELECT m.lang, m.phrase, m.a, l, r, score,
                   row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, m.a DESC, m.phrase) AS rank
            FROM m LEFT JOIN b ON m.lang = b.lang AND m.phrase = b.phrase
            WHERE worst = 1 AND (longer IS NULL OR 100 * longer < 50 * m.a)
        )
        SELECT o.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM o JOIN n ON o.lang = n.lang WHERE rank <= 2000
    """,
}
