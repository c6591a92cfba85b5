"""DuckDB twins of the contract queries that SQL can express."""

ORACLE_SQL = {
    "op5_urls": r"""
        WITH parts AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        urls AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts),
        rules(h, p, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                       ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        fits AS (
            SELECT page_id, h || p AS rule, action, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS n
            FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.action, 'allow') AS verdict
        FROM urls u LEFT JOIN fits f ON u.page_id = f.page_id AND f.n = 1
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_substring": r"""
        WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM texts WHERE len(w) >= 50),
        windows AS (SELECT doc_id, s, array_to_string(w[s : s + 49], ' ') AS k FROM starts),
        firsts AS (SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS pos
            FROM windows JOIN firsts USING (k) WHERE doc_id > first_id),
        lost AS (SELECT doc_id, list(pos) AS positions FROM gone GROUP BY doc_id)
        SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(positions), 0) AS BIGINT) AS n_removed,
               sha256(coalesce(array_to_string(
                   CASE WHEN positions IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(positions, i)) END, ' '), '')) AS kept_sha256
        FROM texts t LEFT JOIN lost l ON t.doc_id = l.doc_id
    """,
    "op10_decontamination": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
        words AS (
            SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x20\x09-\x0D]+') AS w
            FROM texts),
        starts AS (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM words WHERE len(w) > 0),
        shingles AS (SELECT DISTINCT kind, id, array_to_string(w[s : s + 4], ' ') AS shingle FROM starts),
        sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id),
        shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n
            FROM shingles d JOIN shingles i ON d.shingle = i.shingle AND d.kind = 'd' AND i.kind = 'i' GROUP BY d.id, i.id)
        SELECT doc_id, item_id, CAST(shared.n AS INTEGER) AS n_shared, CAST(sizes.n AS INTEGER) AS n_shingles,
               shared.n / sizes.n AS containment
        FROM shared JOIN sizes ON sizes.id = item_id WHERE shared.n >= 0.8 * sizes.n
    """,
    "op12_search": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS nr, text FROM documents UNION ALL
            SELECT 'i', item_id, row_number() OVER (), text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        found AS (
            SELECT kind, id, nr, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
        tfs AS (SELECT kind, id, nr, term, count(*) AS tf FROM found GROUP BY ALL),
        lengths AS (SELECT nr, sum(tf) AS n FROM tfs WHERE kind = 'd' GROUP BY nr),
        totals AS (SELECT count(*) AS docs, sum(n) AS length FROM lengths),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tfs, totals WHERE kind = 'd' GROUP BY term),
        scored AS (
            SELECT i.id AS item_id, i.nr AS item, d.nr, d.id AS doc_id,
                   CAST(sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + CAST((75 * n * docs) // length AS BIGINT))))) AS BIGINT) AS score
            FROM tfs i JOIN tfs d ON i.kind = 'i' AND d.kind = 'd' AND i.term = d.term JOIN weights w ON w.term = i.term
            JOIN lengths l ON l.nr = d.nr, totals GROUP BY ALL),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_spelling": r"""
        WITH RECURSIVE bytes AS (SELECT CAST(range AS BIGINT) AS i FROM range(256)),
        one_byte(i, v, k) AS (
            SELECT i, i, 0 FROM bytes UNION ALL
            SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM one_byte WHERE k < 8),
        crc_table AS (SELECT list(v ORDER BY i) AS t FROM one_byte WHERE k = 8),
        runs AS (
            SELECT doc_id, run, count(*) AS n FROM (
                SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
            WHERE length(run) >= 6 GROUP BY ALL),
        hexed AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
        summed AS (
            SELECT run, n, xor(list_reduce(
                list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
            FROM hexed, crc_table),
        spelt AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
                   ELSE run END AS word, n FROM summed),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        shorter AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS near, b.n AS m FROM shorter a JOIN shorter b USING (d, i) WHERE a.word <> b.word UNION
            SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON b.word = a.d UNION
            SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON b.word = a.d),
        best AS (
            SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, encode(near)) AS near, max(m) AS m FROM near GROUP BY word),
        judged AS (
            SELECT w.word, CASE WHEN m >= 5 * w.n THEN near END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN m END AS form_n
            FROM words w LEFT JOIN best USING (word)),
        follow(word, now, d) AS (
            SELECT word, word, 0 FROM judged UNION ALL SELECT f.word, j.form, d + 1 FROM follow f JOIN judged j ON j.word = f.now WHERE j.form IS NOT NULL),
        roots AS (SELECT word, arg_max(now, d) AS root FROM follow GROUP BY word)
        SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
    """,
}
