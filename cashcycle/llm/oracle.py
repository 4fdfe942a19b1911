"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+')"
_TERMS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op2_minhash": rf"""
        WITH RECURSIVE worded AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
            FROM worded),
        sized AS (SELECT doc_id, len(s)::BIGINT AS n, s FROM sets),
        distinct_sets AS (SELECT min(doc_id) AS doc_id, n, list_sort(s) AS s FROM sized WHERE n > 0 GROUP BY n, list_sort(s)),
        shingles AS (SELECT doc_id, n, unnest(s) AS g FROM distinct_sets),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x
            JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
            GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM distinct_sets
            UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
        smallest AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
        classes AS (SELECT d.s, m.c FROM distinct_sets d JOIN smallest m ON d.doc_id = m.a)
        SELECT z.doc_id, z.n AS n_shingles, coalesce(k.c, z.doc_id) AS component_id, coalesce(k.c, z.doc_id) = z.doc_id AS kept
        FROM sized z LEFT JOIN classes k ON list_sort(z.s) = k.s
    """,
    "op10_embedding_dedup": """
        WITH RECURSIVE vectors AS (SELECT vec_id, min(embedding)::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL GROUP BY vec_id),
        usable AS (
            SELECT vec_id, e FROM vectors
            WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
            ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        smallest AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, s.c AS component_id, s.c = v.vec_id AS kept
        FROM vectors v JOIN smallest s ON s.a = v.vec_id LEFT JOIN counted k ON k.a = v.vec_id
    """,
    "op11_lexical_search": rf"""
        WITH items AS (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id),
        asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM items) GROUP BY ALL),
        docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE doc_id IS NOT NULL),
        totals AS (SELECT count(*)::BIGINT AS N, sum(len(terms))::BIGINT AS L FROM docs WHERE len(terms) > 0),
        sized AS (SELECT r, doc_id, 100 - 75 + ((75 * len(terms)::BIGINT * N) // L) AS m FROM docs, totals WHERE len(terms) > 0),
        counts AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counts, totals GROUP BY term, N),
        scored AS (
            SELECT item_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sized USING (r) GROUP BY item_id, r),
        ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scored JOIN sized USING (r) WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_source_mix": r"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents WHERE doc_id IS NOT NULL),
        sources AS (
            SELECT source, sum(size)::BIGINT AS s, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
            FROM docs GROUP BY source),
        numbered AS (SELECT *, (2 * s)::DOUBLE AS cap, row_number() OVER (ORDER BY 2 * s / w, source NULLS LAST) AS k FROM sources),
        levels AS (
            SELECT *, ((SELECT sum(s) FROM sources)::DOUBLE * 1.5 - coalesce(sum(cap) OVER before, 0))
                / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM numbered WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        final AS (SELECT arg_min(level, k) AS level FROM levels WHERE w * level <= cap),
        plan AS (
            SELECT n.source, s, CASE WHEN f.level IS NULL OR w * f.level > cap THEN cap ELSE w * f.level END AS target
            FROM numbered n, final f),
        whole AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS copies FROM plan),
        rests AS (SELECT *, greatest(target - copies * s, 0) AS rest FROM whole),
        drawn AS (
            SELECT d.doc_id, d.source, d.size, r.rest, r.s,
                (('0x' || substr(md5(d.doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
            FROM docs d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source WHERE r.rest > 0 AND d.size > 0),
        odds AS (SELECT *, (u / (1 - u)) / (rest / (s - rest)) AS q FROM drawn),
        units AS (
            SELECT source, rest, floor(q / (1 + q) * 4503599627370496.0::DOUBLE)::BIGINT AS rank, sum(size)::BIGINT AS words, count(*) AS n
            FROM odds GROUP BY source, rest, rank),
        slices AS (
            SELECT source, rest, rank >> 32 AS slice, sum(words)::BIGINT AS words, sum(n)::BIGINT AS n FROM units GROUP BY ALL),
        sums AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY slice) AS until FROM slices),
        beyond AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY slice) - n AS passed FROM sums WHERE until > rest),
        cuts AS (
            SELECT source, min(slice) AS first, max(slice) AS final, max(rest - until + words) AS room
            FROM beyond WHERE passed < 1000 GROUP BY source),
        near AS (
            SELECT c.source, c.room, list({'rank': u.rank, 'words': u.words} ORDER BY u.rank) AS items
            FROM units u JOIN cuts c ON u.source IS NOT DISTINCT FROM c.source AND (u.rank >> 32) BETWEEN c.first AND c.final
            GROUP BY c.source, c.room),
        walk AS (
            SELECT source, room::DOUBLE AS room, items, 1 AS pos, []::BIGINT[] AS ranks, NULL::BIGINT AS other, NULL::BIGINT AS other_rank FROM near),
        greedy AS (
            WITH RECURSIVE go AS (
                SELECT * FROM walk
                UNION ALL
                SELECT source, CASE WHEN items[pos].words <= room THEN room - items[pos].words ELSE room END, items, pos + 1,
                    CASE WHEN items[pos].words <= room THEN list_append(ranks, items[pos].rank) ELSE ranks END,
                    CASE WHEN items[pos].words > room AND (other IS NULL OR items[pos].words < other) THEN items[pos].words ELSE other END,
                    CASE WHEN items[pos].words > room AND (other IS NULL OR items[pos].words < other) THEN items[pos].rank ELSE other_rank END
                FROM go WHERE pos <= len(items))
            SELECT source, CASE WHEN other < 2 * room THEN list_append(ranks, other_rank) ELSE ranks END AS ranks
            FROM go WHERE pos = len(items) + 1),
        placed AS (
            SELECT o.doc_id, o.source, o.size, floor(q / (1 + q) * 4503599627370496.0::DOUBLE)::BIGINT AS rank FROM odds o),
        sampled AS (
            SELECT DISTINCT p.doc_id, p.source FROM placed p
            LEFT JOIN cuts c ON p.source IS NOT DISTINCT FROM c.source LEFT JOIN greedy g ON p.source IS NOT DISTINCT FROM g.source
            WHERE c.first IS NULL OR (p.rank >> 32) < c.first OR list_contains(g.ranks, p.rank))
        SELECT d.doc_id, d.size, r.s AS source_size, r.target,
            d.size * (r.copies + CASE WHEN x.doc_id IS NULL THEN 0 ELSE 1 END) AS taken
        FROM docs d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
        LEFT JOIN sampled x ON x.doc_id = d.doc_id AND x.source IS NOT DISTINCT FROM d.source
    """,
}
