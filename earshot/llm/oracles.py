"""DuckDB SQL of the operators whose results SQL can express."""

from __future__ import annotations

from .quality import RULES

WORDS = r"[^\x20\x09-\x0D]+"

#: All strings of 100 bytes (as hexadecimal digits) by their digest; every occurrence
#: but the first is repeated, and runs are the islands of what they cover.
SUFFIX = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS code FROM documents
), starts AS (
    SELECT doc_id, code, unnest(range(0, CAST(length(code) // 2 - 99 AS BIGINT))) AS pos FROM texts
), ranked AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY digest ORDER BY doc_id, pos) AS nth
    FROM (SELECT doc_id, pos, md5_number(substring(code, 2 * pos + 1, 200)) AS digest FROM starts)
), marked AS (
    SELECT doc_id, pos, coalesce(pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) > 100, true) AS opens
    FROM ranked WHERE nth > 1
), islands AS (
    SELECT doc_id, pos, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked
), runs AS (
    SELECT doc_id, min(pos) AS first, max(pos) + 100 AS past FROM islands GROUP BY doc_id, run
), before AS (
    SELECT doc_id, first, past, coalesce(lag(past) OVER (PARTITION BY doc_id ORDER BY first), 0) AS since FROM runs
), kept AS (
    SELECT r.doc_id, count(*) AS n_spans, sum(r.past - r.first) AS n_removed, max(r.past) AS past,
        string_agg(substring(t.code, 2 * r.since + 1, 2 * (r.first - r.since)), '' ORDER BY r.first) AS code
    FROM before AS r JOIN texts AS t USING (doc_id) GROUP BY r.doc_id
)
SELECT
    t.doc_id,
    CAST(length(t.code) // 2 AS BIGINT) AS n_bytes,
    CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(k.code, '') || substring(t.code, 2 * coalesce(k.past, 0) + 1))) AS kept_sha256
FROM texts AS t LEFT JOIN kept AS k USING (doc_id)
"""

_MEASURES = {
    "symbol_rate": "n_symbols / greatest(n_words, 1)",
    "exclamation_rate": "bangs / greatest(n_words, 1)",
    "duplicate_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_word_share": "n_repeat_words / greatest(n_words, 1)",
    "capital_share": "capitals / greatest(word_chars, 1)",
    "digit_share": "digits / greatest(word_chars, 1)",
    "mean_word_length": "word_chars / greatest(n_words, 1)",
    "shortness": "1 / greatest(n_words, 1)",
}


def quality_sql(risk: float = 0.01, error: float = 0.05) -> str:
    """The counts, the cutoffs proved on the labels, and the verdicts."""
    grid = ", ".join(f"('{rule}', CAST({cut} AS DOUBLE))" for rule, cuts in RULES.items() for cut in cuts)
    measures = " UNION ALL ".join(f"SELECT nr, doc_id, stratum, '{k}' AS rule, CAST({v} AS DOUBLE) AS measure FROM counted" for k, v in _MEASURES.items())
    return rf"""
WITH split AS (
    SELECT row_number() OVER () AS nr, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS lines
    FROM documents
), windows AS (
    SELECT nr, pos, array_to_string(list_slice(words, pos, pos + 7), ' ') AS shingle
    FROM (SELECT nr, words, unnest(range(1, CAST(len(words) - 6 AS BIGINT))) AS pos FROM split)
), again AS (
    SELECT nr, pos FROM (SELECT nr, pos, count(*) OVER (PARTITION BY nr, shingle) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT nr, sum(width) AS n_repeat_words
    FROM (SELECT nr, least(8, coalesce(pos - lag(pos) OVER (PARTITION BY nr ORDER BY pos), 8)) AS width FROM again)
    GROUP BY nr
), counted AS (
    SELECT s.nr, doc_id, stratum,
        CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        len(lines) AS n_lines,
        length(text) - length(replace(text, '!', '')) AS bangs,
        length(text) - length(translate(text, '0123456789', '')) AS digits,
        length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS capitals
    FROM split AS s LEFT JOIN covered USING (nr)
), measured AS ({measures}
), known AS (
    SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), labelled AS (
    SELECT stratum, rule, measure, quality FROM measured JOIN known USING (doc_id)
), grid AS (
    SELECT * FROM (VALUES {grid}) AS g(rule, cutoff)
), sums AS (
    SELECT stratum, rule, cutoff,
        count(*) FILTER (quality = 1) AS n,
        count(*) FILTER (quality = 1 AND measure > cutoff) AS k,
        count(*) FILTER (quality <> 1 AND measure > cutoff) AS caught
    FROM labelled JOIN grid USING (rule) GROUP BY stratum, rule, cutoff
), likely AS (
    SELECT stratum, rule, cutoff, n, k, caught, unnest(range(0, k + 1)) AS i
    FROM sums WHERE caught > k AND n > 0 AND k <= {risk} * n
), proved AS (
    SELECT stratum, rule, cutoff, caught - k AS gain
    FROM likely GROUP BY stratum, rule, cutoff, n, k, caught
    HAVING sum(exp(lgamma(n + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - CASE WHEN n > i THEN lgamma(n - i + 1) ELSE 0 END
        + i * ln({risk}) + (n - i) * ln(1 - {risk})))
        <= {error} / ((SELECT count(DISTINCT stratum) FROM labelled) * (SELECT count(*) FROM grid))
), chosen AS (
    SELECT stratum, rule, cutoff FROM proved
    QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1
), failed AS (
    SELECT DISTINCT nr FROM measured JOIN chosen USING (stratum, rule) WHERE measure > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND failed.nr IS NULL AS kept
FROM counted LEFT JOIN failed USING (nr)
"""


EXACT = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
    min(doc_id) OVER (PARTITION BY t) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
    sha256(t) AS text_sha256
FROM texts
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every phrase of up to three words by counting all of them.
PHRASES = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), listed AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed
), grams AS (
    SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS p FROM places, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(w)
), counts AS MATERIALIZED (
    SELECT lang, size, p, count(*) AS f FROM grams GROUP BY lang, size, p
), candidates AS MATERIALIZED (
    SELECT lang, size, p, string_split(p, ' ') AS w, f AS a FROM counts WHERE size > 1 AND f >= 10
), splits AS (
    SELECT lang, p, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail
    FROM candidates, (VALUES (1), (2)) AS cut(k) WHERE k < size
), heads AS MATERIALIZED (
    SELECT s.*, c.f AS l FROM splits AS s JOIN counts AS c ON c.lang = s.lang AND c.p = s.head
), cuts AS (
    SELECT s.lang, s.p, s.a, k, l, c.f AS r, CAST(1000000 AS HUGEINT) * s.a * s.a // (CAST(l AS HUGEINT) * c.f) AS score
    FROM heads AS s JOIN counts AS c ON c.lang = s.lang AND c.p = s.tail
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_pairs AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS p, a FROM candidates, (VALUES (1), (2)) AS place(i) WHERE size = 3
), covered AS (
    SELECT DISTINCT s.lang, s.p FROM candidates AS s JOIN inner_pairs AS t ON s.lang = t.lang AND s.p = t.p WHERE 100 * t.a >= 50 * s.a
), totals AS (
    SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang
), ranked AS (
    SELECT lang, p AS phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank
    FROM lowest ANTI JOIN covered USING (lang, p)
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

#: Words by table-driven CRC-32; near words by what is left after one deletion.
VARIANTS = rf"""
WITH RECURSIVE tab AS (
    SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END) ORDER BY c) AS t
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS c)
), runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), each AS (
    SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS code FROM runs GROUP BY id, run
), summed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(0, CAST(length(code) // 2 AS BIGINT)), lambda i: CAST('0x' || substring(code, 2 * i + 1, 2) AS BIGINT))),
        lambda x, b: xor(t[(xor(x, b) & 255) + 1], x >> 8))) AS h
    FROM each, tab
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM summed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS i FROM words)
), near AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut AS a JOIN cut AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM words AS a JOIN cut AS b ON a.word = b.rest
    UNION SELECT a.word, a.n, b.word, b.n FROM cut AS a JOIN words AS b ON a.rest = b.word
), best AS (
    SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n, n
    FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) = 1
), placed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
    FROM words AS w LEFT JOIN best USING (word)
), led AS (
    SELECT word, word AS root, form FROM placed
    UNION ALL
    SELECT l.word, p.word, p.form FROM led AS l JOIN placed AS p ON l.form = p.word
)
SELECT p.word, p.form, l.root, p.n, p.n_near, p.form_n
FROM placed AS p JOIN led AS l ON l.word = p.word AND l.form IS NULL
"""

ORACLES: dict[str, str] = {
    "op6_suffix": SUFFIX,
    "op10_quality": quality_sql(),
    "op11_exact": EXACT,
    "op12_phrases": PHRASES,
    "op13_variants": VARIANTS,
}
