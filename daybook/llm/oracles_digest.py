"""DuckDB SQL for the manifest and the spelling variants."""

from __future__ import annotations

from .merkle import FANOUT, TAMPERED
from .spelling import MIN_COUNT, MIN_LENGTH, MISSPELT, RATIO

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels that the SQL climbs: FANOUT ** 8 documents a language, FANOUT ** 4 languages.
LEVELS, GROUP_LEVELS = 8, 4


def crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a text whose characters lie below U+0800, bit by bit."""
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    utf8 = (f"flatten(list_transform({points}, lambda u: CASE WHEN u < 128 THEN [u::BIGINT] "
            "ELSE [(192 + u // 64)::BIGINT, (128 + u % 64)::BIGINT] END))")
    byte = ("list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], "
            "lambda x, z: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {utf8}), lambda crc, b: {byte}), 4294967295)"


def merkle() -> str:
    """All levels of every language's tree, then those of the languages; each document's path against them."""

    def leaf(text: str) -> str:
        fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({x})::VARCHAR || ':' || {x}, '-')" for x in fields) + ")"

    def levels(name: str, start: str, depth: int) -> list[str]:
        out, node = [], start
        for k in range(depth):
            out.append(f"""{name}{k} AS MATERIALIZED (
                SELECT grp, i // {FANOUT} AS run, list(node ORDER BY i) AS nodes, any_value(n) AS n
                FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM ({node}) q) p GROUP BY grp, i // {FANOUT})""")
            node = f"SELECT grp, run AS i, CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node FROM {name}{k}"
        out.append(f"{name}_top AS MATERIALIZED ({node})")
        return out

    def climb(path: str, name: str, start: str, depth: int) -> list[str]:
        out, before = [], start
        for k in range(depth):
            at = f"((p.i // {FANOUT ** k}) % {FANOUT})"
            out.append(f"""{path}{k} AS (
                SELECT p.* EXCLUDE (proof, folded),
                       CASE WHEN n > 1 THEN p.proof || array_to_string(nodes[1:{at}] || nodes[{at} + 2:], '') ELSE p.proof END AS proof,
                       CASE WHEN n > 1 THEN sha256(array_to_string(nodes[1:{at}] || [p.folded] || nodes[{at} + 2:], '')) ELSE p.folded END AS folded
                FROM {before} p JOIN {name}{k} t ON t.grp IS NOT DISTINCT FROM p.grp AND t.run = p.i // {FANOUT ** (k + 1)})""")
            before = f"{path}{k}"
        return out

    hit = f"{crc32('doc_id::VARCHAR')} % {TAMPERED} = 0"
    given = f"CASE WHEN doc_id IS NOT NULL AND {hit} THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END"
    ctes = [
        f"leaves AS MATERIALIZED (SELECT doc_id, lang AS grp, {leaf('text')} AS leaf, {leaf('given')} AS folded FROM (SELECT *, {given} AS given FROM documents) d)",
        """ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  '' AS proof FROM leaves)""",
        *levels("tree", "SELECT grp, i, leaf AS node FROM ranked", LEVELS),
        *climb("path", "tree", "ranked", LEVELS),
        "groups AS MATERIALIZED (SELECT '' AS grp, grp AS lang, node, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS i FROM tree_top)",
        *levels("upper", "SELECT grp, i, node FROM groups", GROUP_LEVELS),
        f"""mid AS (SELECT p.doc_id, p.leaf, p.proof, p.folded, g.grp, g.i, g.node AS subroot
                   FROM path{LEVELS - 1} p JOIN groups g ON g.lang IS NOT DISTINCT FROM p.grp)""",
        *climb("whole", "upper", "mid", GROUP_LEVELS),
    ]
    return f"""WITH {', '.join(ctes)}
    SELECT doc_id, leaf, subroot, u.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u.node AS verified
    FROM whole{GROUP_LEVELS - 1} w, upper_top u"""


def spelling() -> str:
    """Misspelt occurrences counted, all one-letter deletions of all words, and what these have in common."""
    return f"""
    WITH RECURSIVE runs AS (SELECT doc_id, r, count(*) AS times FROM (
              SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS r FROM documents) x
              WHERE length(r) >= {MIN_LENGTH} GROUP BY doc_id, r),
    hashed AS (SELECT r, times, {crc32("(coalesce(doc_id::VARCHAR, '') || ':' || r)")} AS h FROM runs),
    counted AS (SELECT CASE WHEN h % {MISSPELT} = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word,
                       sum(times)::BIGINT AS n FROM hashed GROUP BY 1),
    words AS MATERIALIZED (SELECT word, n FROM counted WHERE length(word) >= {MIN_LENGTH} AND n >= {MIN_COUNT}),
    cut AS MATERIALIZED (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
                         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words) x),
    met AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT cut.word, cut.n, words.word, words.n FROM cut JOIN words ON words.word = cut.rest
            UNION SELECT words.word, words.n, cut.word, cut.n FROM cut JOIN words ON words.word = cut.rest),
    near AS (SELECT word, any_value(n) AS n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n
             FROM met GROUP BY word),
    forms AS MATERIALIZED (SELECT word, n_near, CASE WHEN best_n >= {RATIO} * n THEN best END AS form, CASE WHEN best_n >= {RATIO} * n THEN best_n END AS form_n FROM near),
    led AS (SELECT word, form AS at FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT led.word, forms.form FROM led JOIN forms ON forms.word = led.at WHERE forms.form IS NOT NULL),
    roots AS (SELECT led.word, led.at AS root FROM led LEFT JOIN forms ON forms.word = led.at WHERE forms.form IS NULL)
    SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(f.n_near, 0) AS n_near, f.form_n
    FROM words w LEFT JOIN forms f ON f.word = w.word LEFT JOIN roots r ON r.word = w.word"""
