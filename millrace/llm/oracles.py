"""SQL (DuckDB) that answers the queries an SQL engine can answer."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY ALL
    HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), components AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components USING (doc_id)
"""

MIXTURE = r"""
WITH d AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
    FROM d GROUP BY source
), filled AS (
    SELECT *, sum(w) OVER (ORDER BY 3 * source_size / w DESC, source) AS open_weight,
        (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (
            ORDER BY 3 * source_size / w, source DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_words
    FROM s
), aims AS (
    SELECT source, source_size, least((
        SELECT open_words::DOUBLE / open_weight::DOUBLE AS share FROM filled
        WHERE open_words::DOUBLE / open_weight::DOUBLE * w <= 3 * source_size
        ORDER BY 3 * source_size / w LIMIT 1) * w, (3 * source_size)::DOUBLE) AS target
    FROM s
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS whole,
        target - whole * source_size AS budget
    FROM aims
), upto AS (
    SELECT source, h, sum(size) AS words,
        sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
    FROM d GROUP BY source, h
), last AS (
    SELECT upto.source,
        CASE WHEN upto - budget < budget - (upto - words) THEN h ELSE h - 1 END AS last_hash
    FROM upto JOIN budgets ON upto.source IS NOT DISTINCT FROM budgets.source
    WHERE budget > 0 AND whole < 3 AND upto >= budget AND upto - words < budget
)
SELECT doc_id, size, source_size, target,
    size * (whole + (h <= coalesce(last_hash, -1))::BIGINT) AS taken
FROM d JOIN budgets ON d.source IS NOT DISTINCT FROM budgets.source
LEFT JOIN last ON d.source IS NOT DISTINCT FROM last.source
"""

# For pages that mark their article, as all test pages do.
MAIN_TEXT = r"""
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM (
    SELECT page_id, url, trim(regexp_replace(replace(replace(
        regexp_replace(regexp_replace(
            regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'),
        '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text
    FROM pages
)
"""

EXACT_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS c
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, v.vec_id,
        list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * v.c[i]))::BIGINT AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM scored
) WHERE rank <= 10
"""

RISK_RULES = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, lang, md5(text) AS text_key, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), placed AS (
    SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM d
), windows AS (
    SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS g
    FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), often AS (
    SELECT doc_id, i FROM windows WHERE g IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM often, (VALUES (0), (1), (2)) s(j) GROUP BY doc_id
), stats AS (
    SELECT doc_id, lang, text_key, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
        len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed
    FROM d LEFT JOIN repeats USING (doc_id)
), shares AS (
    SELECT doc_id, lang, text_key,
        least(CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END, 50000) AS a,
        least(CASE WHEN n_words > 0 THEN word_chars * 1000 // n_words ELSE 0 END, 50000) AS b,
        least(CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END, 50000) AS c,
        least(CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END, 50000) AS e
    FROM stats WHERE NOT base_failed
), known AS (
    SELECT doc_id, min(quality) AS q FROM labels WHERE quality IN (0, 1)
    GROUP BY doc_id HAVING min(quality) = max(quality)
), texts AS (
    SELECT lang, text_key, min(q) = 1 AS good, text_key[1] < '4' AS learn,
        max(a) AS a, max(b) AS b, max(c) AS c, max(e) AS e
    FROM shares JOIN known USING (doc_id) GROUP BY lang, text_key HAVING min(q) = max(q)
), counts AS (
    SELECT lang, rule, share, count(*) AS n FROM (
        SELECT lang, unnest(['a', 'b', 'c', 'e']) AS rule, unnest([a, b, c, e]) AS share
        FROM texts WHERE good AND learn) GROUP BY ALL
), upto AS (
    SELECT *, sum(n) OVER (PARTITION BY lang, rule ORDER BY share) AS upto,
        sum(n) OVER (PARTITION BY lang, rule) AS n_all
    FROM counts
), steps AS (
    SELECT lang, rule, unnest(range(9)) AS step, unnest([
        max(share) * 200 // 100, max(share) * 150 // 100, max(share) * 125 // 100, max(share),
        min(CASE WHEN upto * 1000 >= n_all * 999 THEN share END),
        min(CASE WHEN upto * 1000 >= n_all * 995 THEN share END),
        min(CASE WHEN upto * 1000 >= n_all * 990 THEN share END),
        min(CASE WHEN upto * 1000 >= n_all * 980 THEN share END),
        min(CASE WHEN upto * 1000 >= n_all * 950 THEN share END)]) AS cutoff
    FROM upto GROUP BY lang, rule
), paths AS (
    SELECT lang, step,
        greatest(max(cutoff) FILTER (rule = 'a'), 100) AS ca, greatest(max(cutoff) FILTER (rule = 'b'), 10000) AS cb,
        greatest(max(cutoff) FILTER (rule = 'c'), 200) AS cc, greatest(max(cutoff) FILTER (rule = 'e'), 300) AS ce
    FROM steps GROUP BY lang, step
), tested AS (
    SELECT paths.lang, step,
        count(*) FILTER (good AND NOT learn) AS n,
        count(*) FILTER (good AND NOT learn AND (a > ca OR b > cb OR c > cc OR e > ce)) AS k,
        count(*) FILTER (good AND learn) AS goods, count(*) FILTER (NOT good AND learn) AS bads,
        count(*) FILTER (good AND learn AND (a > ca OR b > cb OR c > cc OR e > ce)) AS good_out,
        count(*) FILTER (NOT good AND learn AND (a > ca OR b > cb OR c > cc OR e > ce)) AS bad_out
    FROM paths JOIN texts ON paths.lang IS NOT DISTINCT FROM texts.lang GROUP BY paths.lang, step
), tails AS (
    SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(
            lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)))) AS p
    FROM tested
), certified AS (
    SELECT * FROM tails
    QUALIFY max(p) OVER (PARTITION BY lang ORDER BY step) <= 0.05 / (SELECT count(DISTINCT coalesce(lang, '')) FROM paths)
), chosen AS (
    SELECT * FROM certified JOIN paths ON certified.lang IS NOT DISTINCT FROM paths.lang AND certified.step = paths.step
    QUALIFY row_number() OVER (PARTITION BY certified.lang
        ORDER BY bad_out * goods - good_out * bads DESC, certified.step) = 1
)
SELECT stats.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(s.a > ca OR s.b > cb OR s.c > cc OR s.e > ce, false) AS kept
FROM stats LEFT JOIN shares s ON stats.doc_id = s.doc_id LEFT JOIN chosen ON stats.lang IS NOT DISTINCT FROM chosen.lang
"""

RESAMPLING = r"""
WITH RECURSIVE bits AS (
    SELECT range AS b, range AS v, 0 AS k FROM range(256)
    UNION ALL
    SELECT b, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
    SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8
), d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), seen AS (
    SELECT doc_id, unnest(w) AS word FROM d
), aims AS (
    SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark
), words AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(
            range(1, octet_length(encode(word)) + 1),
            lambda i: ('0x' || substr(hex(encode(word)), 2 * i - 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT word FROM seen UNION SELECT word FROM aims), crc
), corpus AS (
    SELECT bucket, count(*)::DOUBLE AS s FROM seen JOIN words USING (word) GROUP BY bucket
), target AS (
    SELECT bucket, count(*)::DOUBLE AS t FROM aims JOIN words USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM seen)::DOUBLE + 10000)
        / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM aims)::DOUBLE + 10000))))::BIGINT AS gain
    FROM (SELECT DISTINCT bucket FROM words) LEFT JOIN corpus USING (bucket) LEFT JOIN target USING (bucket)
), weights AS (
    SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight
    FROM seen JOIN words USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
    FROM d LEFT JOIN weights USING (doc_id)
), ranked AS (
    SELECT *, CASE WHEN n_features >= 20 THEN
        row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place
    FROM scored
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
FROM ranked
"""
