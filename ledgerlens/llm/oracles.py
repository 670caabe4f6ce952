"""SQL for the queries over terms, words and urls, as another engine runs it on the same tables."""

ORACLE = {
    "op11_lexical_search": r"""
WITH docs AS (
    SELECT row_number() OVER () AS nth, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
totals AS (SELECT count(*) AS N, sum(len(terms))::BIGINT AS L FROM docs WHERE len(terms) > 0),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
held AS (SELECT nth, term, count(*) AS tf FROM (SELECT nth, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(N) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, totals WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * len(terms) * N) // L)))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN docs USING (nth), totals
    GROUP BY item_id, nth, doc_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op12_spelling": r"""
WITH runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run),
numbered AS (SELECT *, row_number() OVER () AS nth, hex(encode(id || ':' || run)) AS h FROM counted),
bytes AS (  -- place from the end and value; the first four are inverted, as the checksum starts from all ones
    SELECT nth, len(h) // 2 - i - 1 AS place, xor(('0x' || substr(h, 2 * i + 1, 2))::BIGINT, CASE WHEN i < 4 THEN 255 ELSE 0 END) AS byte
    FROM (SELECT nth, h, unnest(range(len(h) // 2)) AS i FROM numbered)),
steps AS (  -- eight steps of the checksum for each byte
    WITH RECURSIVE shifted AS (
        SELECT i AS byte, i AS c, 0 AS step FROM range(256) t(i)
        UNION ALL SELECT byte, xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), step + 1 FROM shifted WHERE step < 8)
    SELECT byte, c FROM shifted WHERE step = 8),
shares AS (  -- what a byte at a place adds to the checksum
    WITH RECURSIVE further AS (
        SELECT byte, c, 0::BIGINT AS place FROM steps
        UNION ALL SELECT f.byte, xor(f.c >> 8, s.c), place + 1 FROM further f JOIN steps s ON s.byte = f.c % 256
                  WHERE place < (SELECT max(place) FROM bytes))
    SELECT * FROM further),
summed AS (
    SELECT id, run, n, crc FROM numbered JOIN (
        SELECT nth, xor(bit_xor(c), 4294967295) AS crc FROM bytes JOIN shares USING (place, byte) GROUP BY nth) USING (nth)),
cut AS (
    SELECT n, CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word
    FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
    UNION SELECT b.word, a.word, a.n FROM words a JOIN less b ON a.word = b.rest),
best AS (
    SELECT word, count(*) AS n_near, min(struct_pack(n := -other_n, other := hex(encode(other)), word := other)) AS most
    FROM near GROUP BY word),
formed AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN -most.n >= 5 * w.n THEN most.word END AS form, CASE WHEN -most.n >= 5 * w.n THEN -most.n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
hop1 AS MATERIALIZED (SELECT word, coalesce(form, word) AS root FROM formed),
hop2 AS MATERIALIZED (SELECT a.word, b.root FROM hop1 a JOIN hop1 b ON a.root = b.word),
hop4 AS MATERIALIZED (SELECT a.word, b.root FROM hop2 a JOIN hop2 b ON a.root = b.word),
hop8 AS MATERIALIZED (SELECT a.word, b.root FROM hop4 a JOIN hop4 b ON a.root = b.word),
walk AS (SELECT a.word, b.root FROM hop8 a JOIN hop8 b ON a.root = b.word)  -- 16 steps: frequencies grow fivefold a step
SELECT word, form, root, n, n_near, form_n FROM formed JOIN walk USING (word)""",
    "op13_url_filter": r"""
WITH seen AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
outcomes AS (
    SELECT doc_id AS page_id, count(*) AS n, count(*) FILTER (quality = 0 OR toxic = 1) AS bad
    FROM labels WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id),
hosts AS (
    SELECT host, sum(coalesce(n, 0)) AS n, sum(coalesce(bad, 0)) AS bad,
           string_split(regexp_replace(host, '^.*@|:[0-9]*$|\.+(:[0-9]*)?$', '', 'g'), '.') AS parts
    FROM seen LEFT JOIN outcomes USING (page_id) GROUP BY host),
split_ AS (
    SELECT *, CASE WHEN regexp_full_match(parts[-1], '[0-9]+') THEN ''
                   WHEN array_to_string(parts[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'co.nz', 'com.br') THEN array_to_string(parts[-2:], '.')
                   ELSE parts[-1] END AS suffix
    FROM hosts),
placed AS (
    SELECT *, CASE WHEN suffix = '' THEN array_to_string(parts, '.')
                   ELSE array_to_string(parts[-(len(string_split(suffix, '.')) + 1):], '.') END AS domain
    FROM split_),
s0 AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM placed) AS mean
    FROM placed GROUP BY suffix),
s1 AS (
    SELECT suffix, (bad + prior * mean) / (n + prior) AS mean FROM s0, (
        SELECT 1 / least(greatest(coalesce(CASE WHEN sum(mean * (1 - mean) * (n - 1)) > 0 THEN (sum(n * (bad / n - mean) ** 2) - sum(mean * (1 - mean)))
               / sum(mean * (1 - mean) * (n - 1)) END, 0.001), 0.001), 0.5) - 1 AS prior FROM s0 WHERE n > 0)),
d0 AS (
    SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS mean FROM placed JOIN s1 USING (suffix) GROUP BY domain, suffix),
d1 AS (
    SELECT domain, suffix, (bad + prior * mean) / (n + prior) AS mean FROM d0, (
        SELECT 1 / least(greatest(coalesce(CASE WHEN sum(mean * (1 - mean) * (n - 1)) > 0 THEN (sum(n * (bad / n - mean) ** 2) - sum(mean * (1 - mean)))
               / sum(mean * (1 - mean) * (n - 1)) END, 0.001), 0.001), 0.5) - 1 AS prior FROM d0 WHERE n > 0)),
h0 AS (SELECT host, n, bad, mean FROM placed JOIN d1 USING (domain, suffix)),
h1 AS (
    SELECT host, n + prior AS weight, (bad + prior * mean) / (n + prior) AS share FROM h0, (
        SELECT 1 / least(greatest(coalesce(CASE WHEN sum(mean * (1 - mean) * (n - 1)) > 0 THEN (sum(n * (bad / n - mean) ** 2) - sum(mean * (1 - mean)))
               / sum(mean * (1 - mean) * (n - 1)) END, 0.001), 0.001), 0.5) - 1 AS prior FROM h0 WHERE n > 0)),
judged AS (SELECT host, share - 1.645 * sqrt(share * (1 - share) / (weight + 1)) > 0.5 AS bad FROM h1),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
    SELECT s.host, s.path, arg_max(struct_pack(rule := rhost || rpath, verdict := verdict), len(rhost || rpath) * 1000 + len(rhost)) AS fit
    FROM (SELECT DISTINCT host, path FROM seen) s JOIN rules ON (s.host = rhost OR ends_with(s.host, '.' || rhost)) AND starts_with(s.path, rpath)
    GROUP BY s.host, s.path)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM seen LEFT JOIN fits USING (host, path) JOIN judged USING (host)""",
}
