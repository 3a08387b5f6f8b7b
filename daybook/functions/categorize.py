"""Title -> activity category as one Column expression (no UDF).

Rules are evaluated in order; the first rule whose keywords occur anywhere in the
trimmed, lower-cased title wins. Empty or null titles are `other`; no match is `work`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CATEGORIES = ("work", "personal", "learning", "meeting", "other")

# Keyword rules that must equal the source system's categoriser,
# in its evaluation order (substring match, case-insensitive).
DEFAULT_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("other", ("ooo", "out of office", "holiday", "vacation", "pto", "blocker",
               "focus", "deep work", "no meetings")),
    ("meeting", ("sync", "standup", "stand-up", "stand up", "review", "retro", "1:1",
                 "1-on-1", "1 on 1", "interview", "planning", "daily", "weekly",
                 "meeting", "demo", "triage", "grooming", "sprint", "all-hands")),
    ("learning", ("study", "course", "lecture", "tutorial", "workshop", "reading",
                  "class", "training", "pairing", "pair programming")),
    ("personal", ("dentist", "doctor", "gym", "lunch", "break", "personal", "errand",
                  "haircut", "family", "dinner", "coffee")),
)
DEFAULT_CATEGORY = "work"
EMPTY_CATEGORY = "other"


def unicode_trim(c: Column) -> Column:
    """Strip leading/trailing Unicode whitespace (Spark's `trim` strips spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def categorize(
    title: Column | str,
    rules: Sequence[tuple[str, Sequence[str]]] = DEFAULT_RULES,
    default: str = DEFAULT_CATEGORY,
) -> Column:
    col = F.col(title) if isinstance(title, str) else title
    text = F.coalesce(col, F.lit(""))
    # Trimming cannot change whether a keyword (no outer whitespace) is contained, so the
    # (regex) trim is only needed for the emptiness test; keyword tests use the cheap form,
    # which stays cheap even where the engine cannot share it across CASE branches.
    t = F.lower(text)
    expr = F.when(unicode_trim(text) == "", F.lit(EMPTY_CATEGORY))
    for category, keywords in rules:
        hit = None
        for kw in keywords:
            cond = t.contains(kw.lower())
            hit = cond if hit is None else (hit | cond)
        if hit is not None:
            expr = expr.when(hit, F.lit(category))
    return expr.otherwise(F.lit(default))


def categorize_sql(expr: str, rules=DEFAULT_RULES, default: str = DEFAULT_CATEGORY) -> str:
    """The same rule chain as portable SQL text (used by oracle queries)."""
    t = f"lower(coalesce({expr}, ''))"
    empty = f"regexp_replace(coalesce({expr}, ''), '^\\s+|\\s+$', '', 'g') = ''"
    parts = [f"WHEN {empty} THEN '{EMPTY_CATEGORY}'"]
    for category, keywords in rules:
        cond = " OR ".join(f"contains({t}, '{kw.lower()}')" for kw in keywords)
        parts.append(f"WHEN {cond} THEN '{category}'")
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"
