"""DuckDB SQL for the operators whose full result SQL can express."""

from __future__ import annotations

from . import oracles_digest
from .repetition import LINE_LIMIT, MAX_REPEATED_PERCENT, MIN_WORDS, NGRAM_LIMITS
from .repetition import WINDOW as QUALITY_WINDOW
from .substring_dedup import WINDOW

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quality() -> str:
    """Every window of every length by brute force, lines by their number."""
    lengths = sorted({QUALITY_WINDOW, *NGRAM_LIMITS})
    windows = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS n, unnest(range(1, len(ws) - {n - 2})) AS s, ws FROM w" for n in lengths)
    shares = ", ".join(f"coalesce(max(CASE WHEN n = {n} THEN share END), 0.0) AS share_{n}" for n in sorted(NGRAM_LIMITS))
    fine = " AND ".join([f"share_{n} <= {most}" for n, most in sorted(NGRAM_LIMITS.items())] + [f"line_share <= {LINE_LIMIT}"])
    return rf"""
    WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
    spot AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
    grams AS (SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS g FROM ({windows}) x),
    seen AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n, g ORDER BY s) AS place,
                    count(*) OVER (PARTITION BY doc_id, n, g) AS times FROM grams),
    again AS (SELECT DISTINCT doc_id, n, s + k AS i FROM seen, range(0, {max(lengths)}) t(k) WHERE place > 1 AND k < n),
    any_of AS (SELECT DISTINCT doc_id, s + k AS i FROM seen, range(0, {QUALITY_WINDOW}) t(k) WHERE times > 1 AND n = {QUALITY_WINDOW}),
    size AS (SELECT w.doc_id, any_value(text) AS text, count(word) AS n_words, CAST(coalesce(sum(length(word)), 0) AS BIGINT) AS word_chars
             FROM w LEFT JOIN spot ON spot.doc_id = w.doc_id GROUP BY w.doc_id),
    shared AS (SELECT a.doc_id, n, sum(length(word)) / max(word_chars) AS share FROM again a JOIN spot USING (doc_id, i)
               JOIN size ON size.doc_id = a.doc_id GROUP BY 1, 2),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM w),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS place FROM lines WHERE regexp_matches(line, '{_WORD}')),
    by_line AS (SELECT doc_id, count(*) FILTER (WHERE place > 1) AS n_dup_lines,
                       coalesce(sum(strlen(line)) FILTER (WHERE place > 1), 0) / greatest(sum(strlen(line)), 1) AS line_share
                FROM numbered GROUP BY doc_id),
    measured AS (
        SELECT s.doc_id, s.n_words, s.word_chars, CAST(length(regexp_replace(any_value(s.text), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               coalesce(any_value(b.n_dup_lines), 0) AS n_dup_lines, (SELECT count(*) FROM any_of WHERE any_of.doc_id = s.doc_id) AS n_repeat_words,
               coalesce(any_value(b.line_share), 0.0) AS line_share, {shares}
        FROM size s LEFT JOIN shared ON shared.doc_id = s.doc_id LEFT JOIN by_line b ON b.doc_id = s.doc_id
        GROUP BY s.doc_id, s.n_words, s.word_chars),
    judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM measured)
    SELECT *, NOT base_failed AND {fine} AS kept FROM judged"""


def _substrings() -> str:
    """Every window as text, ranked by (document, start)."""
    return rf"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
    win AS (SELECT doc_id, unnest(range(1, len(ws) - {WINDOW - 2})) AS s, ws FROM w),
    ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(ws[s:s + {WINDOW - 1}], ' ') ORDER BY doc_id, s) AS place FROM win),
    gone AS (SELECT DISTINCT doc_id, s + k AS i FROM ranked, range(0, {WINDOW}) t(k) WHERE place > 1),
    words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
    marked AS (SELECT x.doc_id, x.word, x.i, g.i IS NOT NULL AS drop_it FROM words x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.i = x.i)
    SELECT w.doc_id, count(word) AS n_words, count(*) FILTER (WHERE drop_it) AS n_removed,
           sha256(coalesce(string_agg(word, ' ' ORDER BY m.i) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
    FROM w LEFT JOIN marked m ON m.doc_id = w.doc_id GROUP BY w.doc_id"""


def _lines(least: int, near: int) -> str:
    """Distinct lines, all their one-word deletions, and what these have in common."""
    return rf"""
    WITH line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k
                  FROM documents WHERE text IS NOT NULL),
    worded AS (SELECT *, doc_id * 16777216 + k AS p, regexp_extract_all(translate(line, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM line),
    kinds AS (SELECT ws, len(ws) AS n, min(p) AS p FROM worded WHERE len(ws) >= {least} GROUP BY ws),
    cut AS (SELECT ws, p, i, list_concat(ws[1:i - 1], ws[i + 1:]) AS rest
            FROM (SELECT ws, p, unnest(range(1, n + 1)) AS i FROM kinds WHERE n >= {near}) x),
    met AS (SELECT ws, min(p) OVER (PARTITION BY rest, i) AS p FROM cut
            UNION ALL SELECT cut.ws, kinds.p FROM cut JOIN kinds ON kinds.ws = cut.rest AND kinds.n >= {near}
            UNION ALL SELECT kinds.ws, cut.p FROM cut JOIN kinds ON kinds.ws = cut.rest AND kinds.n >= {near}
            UNION ALL SELECT ws, p FROM kinds),
    earliest AS (SELECT ws, min(p) AS p FROM met GROUP BY ws),
    marked AS (SELECT worded.*, coalesce(earliest.p < worded.p, false) AS drop_it FROM worded LEFT JOIN earliest ON earliest.ws = worded.ws)
    SELECT d.doc_id, CASE WHEN coalesce(any_value(d.text), '') = '' THEN 0 ELSE count(k) END AS n_lines,
           count(*) FILTER (WHERE drop_it) AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
    FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id"""


def oracle_sql() -> dict[str, str]:
    from .line_dedup import MIN_WORDS as LEAST
    from .line_dedup import NEAR_WORDS

    return {"op3_quality_rules": _quality(), "op4_substring_dedup": _substrings(), "op5_line_dedup": _lines(LEAST, NEAR_WORDS),
            "op11_merkle_manifest": oracles_digest.merkle(), "op12_spelling_variants": oracles_digest.spelling()}
