"""DuckDB SQL for the rows of queries that SQL can express."""

from __future__ import annotations

from landfall.llm.licenses import NOTICE_LINE, SPELLINGS, known_texts

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _normal(text: str) -> str:
    """A text's normal form with its line ends."""
    no_copyright = f"regexp_replace(lower({text}), '(?m){NOTICE_LINE}', '', 'g')"
    plain = rf"regexp_replace({no_copyright}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for written, taken in SPELLINGS:
        plain = f"replace({plain}, {_quoted(written)}, {_quoted(taken)})"
    return plain


_ONE_LINE = r"trim(regexp_replace({}, '[ \n]+', ' ', 'g'))"

_KNOWN = ", ".join("(" + ", ".join(map(_quoted, row)) + ")" for row in known_texts())

OP9 = f"""
WITH known AS (
    SELECT sha256(n) AS digest, min(id) AS license_id
    FROM (SELECT id, {_ONE_LINE.format(_normal("t"))} AS n
          FROM (SELECT id, unnest([title || chr(10) || terms || chr(10) || appendix,
                                   terms || chr(10) || appendix,
                                   title || chr(10) || terms, terms]) AS t
                FROM (VALUES {_KNOWN}) AS v(id, title, terms, appendix)))
    WHERE n <> '' GROUP BY n
), docs AS (
    SELECT row_number() OVER () AS uid, doc_id, {_normal("text")} AS lines FROM documents
), found AS (
    SELECT uid, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids
    FROM (SELECT uid, unnest(string_split(lines, chr(10))) AS line FROM docs) AS l
    JOIN known ON known.digest = sha256(trim(l.line))
    GROUP BY uid
)
SELECT doc_id, sha256({_ONE_LINE.format("lines")}) AS text_digest, license_id,
       coalesce(n, 0) AS n_license_lines, coalesce(ids, '') AS line_license_ids
FROM docs
LEFT JOIN known ON known.digest = sha256({_ONE_LINE.format("lines")})
LEFT JOIN found USING (uid)
"""

_WORDS = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP8 = f"""
WITH docs AS (SELECT row_number() OVER () AS uid, doc_id, {_WORDS} AS w FROM documents),
items AS (
    SELECT item_id, w, least(10, len(w)) AS n
    FROM (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL)
    WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), grams AS (
    SELECT uid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM docs CROSS JOIN (SELECT DISTINCT n FROM items) WHERE len(w) >= n)
), matched AS (
    SELECT uid, i, n, item_id FROM grams JOIN windows USING (gram, n)
), hits AS (
    SELECT uid, count(DISTINCT place) AS n_hit
    FROM (SELECT uid, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT uid, i, n FROM matched))
    GROUP BY uid
), named AS (
    SELECT uid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT uid, CAST(item_id AS VARCHAR) AS item_id FROM matched) GROUP BY uid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (uid) LEFT JOIN named USING (uid)
"""

OP11 = rf"""
WITH pieces AS (
    SELECT lang, [x FOR x IN string_split_regex(piece, '[ \t]+') IF x <> ''] AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
              translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\n\x0B\f\r]')) AS piece
          FROM documents)
), counted AS (
    SELECT lang, k, phrase, count(*) AS f
    FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM pieces, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k))
    GROUP BY lang, k, phrase
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w
    FROM counted WHERE k > 1 AND f >= 10
), cuts AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.w, c.cut, l.f AS l, r.f AS r,
           CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) AS c
    JOIN counted AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.cut], ' ')
    JOIN counted AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), worst AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
    SELECT lang, phrase, max(a) AS a
    FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
          FROM candidates WHERE k = 3)
    GROUP BY lang, phrase
), kept AS (
    SELECT worst.* FROM worst
    LEFT JOIN longer ON longer.lang = worst.lang AND longer.phrase = worst.phrase
    WHERE longer.a IS NULL OR 100 * longer.a < 50 * worst.a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (
          PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN totals USING (lang)
WHERE rank <= 2000
"""

ORACLE = {"op8_decontamination": OP8, "op9_license_scan": OP9, "op11_phrases": OP11}
