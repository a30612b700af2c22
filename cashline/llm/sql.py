"""DuckDB SQL for the rows of the queries, written from the contracts and not from the operators."""

from __future__ import annotations

# Runs of the fewest lines with 50 words from and up to each line; all but the first of equal runs go.
OP3_LINE_DEDUP = r"""
WITH t AS (SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents), l AS (
    SELECT doc_id, p, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w
    FROM (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS p, unnest(lines) AS line FROM t)
), c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS upto FROM l), runs AS (
    SELECT DISTINCT a.doc_id, a.p AS s, b.p AS e
    FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.p >= a.p AND b.upto - a.upto + a.w >= 50
        AND (b.upto - b.w - a.upto + a.w < 50 OR b.upto - a.upto < 50)
), named AS (
    SELECT runs.doc_id, s, e, array_to_string(lines[s:e], chr(10)) AS content FROM runs JOIN t USING (doc_id)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS n FROM named
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS p FROM ranked WHERE n > 1
), kept AS (
    SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.p) AS text
    FROM l LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY l.doc_id
), counted AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT t.doc_id, len(lines)::INTEGER AS n_lines, coalesce(counted.n, 0)::INTEGER AS n_deleted,
    CASE WHEN t.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

OP4_BACKOFF_LM = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), w AS (
    SELECT doc_id, p, words[p] AS word, CASE WHEN p > 1 THEN words[p - 1] END AS before,
        CASE WHEN p > 2 THEN words[p - 2] END AS first
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d)
), one AS (SELECT word, count(*) AS n FROM w GROUP BY word), two AS (
    SELECT before, word, count(*) AS n FROM w WHERE before IS NOT NULL GROUP BY before, word
), three AS (
    SELECT first, before, word, count(*) AS n FROM w WHERE first IS NOT NULL GROUP BY first, before, word
), total AS (SELECT count(*) AS n FROM w), s AS (
    SELECT w.doc_id, sum(CASE WHEN three.n >= 2 THEN ln(three.n / pair.n)
        ELSE CASE WHEN w.first IS NOT NULL THEN ln(0.4) ELSE 0 END + CASE WHEN two.n >= 2 THEN ln(two.n / context.n)
            WHEN w.before IS NOT NULL THEN ln(0.4) + ln(one.n / total.n) ELSE ln(one.n / total.n) END END) AS score
    FROM w JOIN one ON one.word = w.word LEFT JOIN two ON two.before = w.before AND two.word = w.word
        LEFT JOIN one context ON context.word = w.before
        LEFT JOIN three ON three.first = w.first AND three.before = w.before AND three.word = w.word
        LEFT JOIN two pair ON pair.before = w.first AND pair.word = w.before, total
    GROUP BY w.doc_id
)
SELECT d.doc_id, len(words) AS n_words, round(coalesce(score, 0), 4) AS log_score,
    CASE WHEN len(words) > 0 THEN round(score / len(words), 6) END AS mean_log_score
FROM d LEFT JOIN s USING (doc_id)
"""

# All windows of the items against all windows of the same length in the documents.
OP6_DECONTAMINATION = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, words[p:p + 9] AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS p FROM b WHERE len(words) > 0)
), lengths AS (SELECT DISTINCT len(w) AS n FROM windows), places AS (
    SELECT doc_id, p, n, words[p:p + n - 1] AS w
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS p
        FROM d, lengths WHERE len(words) >= n)
), hits AS (SELECT doc_id, p, n, item_id FROM places JOIN windows USING (w)), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + n)) AS p FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# Matches per kind with the text between them; places are running sums of both lengths.
OP7_SECRET_SCAN = r"""
WITH patterns(kind, k, pattern, g, least) AS (VALUES
    ('assign', 0, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
    ('access', 1, 'AKIA[A-Z0-9]+', 0, 18),
    ('hex', 2, '[0-9a-f]+', 0, 16),
    ('owned', 3, '[A-Za-z0-9+/_=-]+', 0, 20)
), texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents), found AS (
    SELECT doc_id, source, kind, k, least, string_split_regex(text, pattern) AS gaps,
        regexp_extract_all(text, pattern, 0) AS whole,
        CASE WHEN g = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern, 0) END AS secrets
    FROM texts, patterns WHERE regexp_matches(text, pattern)
), each AS (
    SELECT doc_id, source, kind, k, least, p, length(gaps[p]) AS gap, length(whole[p]) AS own, secrets[p] AS secret
    FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS p FROM found)
), placed AS (
    SELECT *, (sum(gap + own) OVER (PARTITION BY doc_id, kind ORDER BY p) - own)::BIGINT AS s FROM each
), base AS (
    SELECT doc_id, source, kind, k, s, s + own AS e, secret FROM placed
    WHERE length(secret) >= least AND (k < 3 OR regexp_matches(secret, '[0-9]') AND regexp_matches(secret, '[A-Za-z]'))
), spans AS (
    SELECT * FROM base WHERE k < 3
    UNION ALL SELECT * FROM base m WHERE k = 3 AND NOT EXISTS (
        SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.k < 3 AND m.s < b.e AND b.s < m.e)
), owners AS (
    SELECT secret, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS n_owners,
        count(DISTINCT (source, doc_id)) AS n_places
    FROM spans GROUP BY secret
), summed AS (
    SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
        count(*) FILTER (k = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS listed,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS every,
        count(*) FILTER (n_owners = 1 AND n_places <= 2) AS n_live, count(*) FILTER (n_owners >= 3) AS n_shared
    FROM spans JOIN owners USING (secret) WHERE k < 3 OR n_owners = 1 GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(listed, '')) AS base_sha256, coalesce(every, '') AS spans,
    coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared
FROM texts LEFT JOIN summed USING (doc_id)
"""

OP8_WARC = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages), h AS (
    SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p
), f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM h)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

# Words with the 0-based place of each; and per place the five words from there.
OP9_QUALITY_RULES = r"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, p, words[p:p + 4] AS five
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5)
), twice AS (
    SELECT doc_id, unnest(range(p, p + 5)) AS p
    FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows) WHERE n >= 2
), repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice GROUP BY doc_id), m AS (
    SELECT w.doc_id, len(words) AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        len(regexp_extract_all(text, '[!?]')) AS n_marks,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(repeats.n, 0) AS n_repeat_words
    FROM w LEFT JOIN repeats ON repeats.doc_id = w.doc_id
), bits AS (
    SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 10 * word_chars THEN 4 ELSE 0 END
        + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN 100 * n_marks > 15 * word_chars THEN 16 ELSE 0 END
        + CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END AS failed
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
    failed = 0 AS kept, failed::BIGINT AS failed_rules
FROM bits
"""

# The bits of the same ledger under the masks of both policies, rule by rule.
QUALITY_ABLATIONS = (
    OP9_QUALITY_RULES[: OP9_QUALITY_RULES.rindex("SELECT doc_id, n_words")]
    + r"""
, policies(policy, mask) AS (VALUES (1, 3), (2, 63)), rules(rule, bit) AS (VALUES
    ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('duplicate_lines', 8), ('shouting', 16), ('long_words', 32)
)
SELECT policy, rule, count(*) FILTER (failed & bit <> 0) AS n_failed,
    count(*) FILTER (failed & mask = bit) AS n_only, count(*) FILTER (failed & mask & ~bit = 0) AS n_kept_without
FROM bits, policies JOIN rules ON bit & mask <> 0 GROUP BY policy, rule
"""
)

# Pairs by shared shingles, then all that each document reaches over links.
OP10_MINMAX_DEDUP = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, words[p:p + 4] AS five
    FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS p FROM d WHERE len(words) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.five = b.five AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


# Counts per group and kept term, zeros included; then every two groups, and each group with its language.
OP11_DIVERGENCE = r"""
WITH t AS (
    SELECT doc_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (
        SELECT row_number() OVER () AS doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    )
), g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents), k AS (
    SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 10
), c AS (
    SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term
), x AS (
    SELECT g.lang, g.source, k.term, lang_n, coalesce(n, 0) AS n
    FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
    SELECT lang, source, term, n,
        1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER s + 2 * count(*) OVER s)::HUGEINT AS p,
        1 + 1000000000::HUGEINT * (lang_n + 2) // (sum(lang_n) OVER s + 2 * count(*) OVER s)::HUGEINT AS q
    FROM x WINDOW s AS (PARTITION BY lang, source)
), pairs AS (
    SELECT g.lang, g.source, h.source AS item, coalesce(value, 0) AS value
    FROM g JOIN g h ON h.lang = g.lang AND h.source <> g.source LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ) v ON v.lang = g.lang AND v.source = g.source AND v.item = h.source
), terms AS (
    SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value,
        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
    UNION ALL
    SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
        row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 10
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""

# Bytes as pairs of hex digits. Removed runs begin where no window before reaches, and kept text lies between them.
OP12_BYTE_REPEATS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), w AS (
    SELECT r, p, md5(substr(h, 2 * p + 1, 400)) AS content
    FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM d WHERE length(h) >= 400)
), hit AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY content) AS n FROM w) WHERE n > 1), o AS (
    SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM hit
), s AS (
    SELECT r, p, sum(CASE WHEN p - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run FROM o
), runs AS (SELECT r, run, min(p) AS a, max(p) + 200 AS b FROM s GROUP BY r, run), gaps AS (
    SELECT r, run, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY run), 0) AS since FROM runs
), k AS (
    SELECT r, count(*) AS n_spans, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY run) AS front
    FROM gaps JOIN d USING (r) GROUP BY r
), t AS (SELECT r, sum(b - a) AS n_removed, max(b) AS last FROM runs GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (r) LEFT JOIN t USING (r)
"""

# A mask per document, then every order of the five letters and every step of it.
OP13_FILTER_AUDIT = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id), m AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN d.doc_id > least THEN 16 ELSE 0 END AS mask
    FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), c AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL), f(letter, own) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), o AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM f a, f b, f c, f d, f e WHERE a.own + b.own + c.own + d.own + e.own = 31
        AND len(list_distinct([a.own, b.own, c.own, d.own, e.own])) = 5
), s AS (
    SELECT filter_order, step, letter, own,
        (SELECT coalesce(sum(g.own), 0) FROM f g WHERE contains(left(filter_order, step - 1), g.letter))::INTEGER AS before
    FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o) x JOIN f ON f.letter = substr(filter_order, step, 1)
), a AS (
    SELECT part, filter_order, step::INTEGER AS step, letter,
        coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
        coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0 AND good), 0)::BIGINT AS good_lost,
        coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0 AND toxic), 0)::BIGINT AS toxic_lost
    FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM a
"""


def all_oracles() -> dict[str, str]:
    return {
        "op3_line_dedup": OP3_LINE_DEDUP,
        "op4_backoff_lm": OP4_BACKOFF_LM,
        "op6_decontamination": OP6_DECONTAMINATION,
        "op7_secret_scan": OP7_SECRET_SCAN,
        "op8_warc": OP8_WARC,
        "op9_quality_rules": OP9_QUALITY_RULES,
        "quality_ablations": QUALITY_ABLATIONS,
        "op10_minmax_dedup": OP10_MINMAX_DEDUP,
        "op11_divergence": OP11_DIVERGENCE,
        "op12_byte_repeats": OP12_BYTE_REPEATS,
        "op13_filter_audit": OP13_FILTER_AUDIT,
    }
