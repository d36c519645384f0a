"""Rule tests as Spark SQL expression text.

A rule set of hundreds of patterns compiled through the Column API costs
thousands of driver-to-JVM calls per query build; the same expressions as SQL
text are parsed by Spark in one call per column. The generated expressions
are plain ``contains`` / ``CASE`` trees, evaluated in whole-stage codegen.
"""

from __future__ import annotations


def sql_str(v: str) -> str:
    """A Spark SQL string literal (backslash escapes are processed by the parser)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_array(values) -> str:
    return "array(" + ", ".join(sql_str(v) for v in values) + ")"


def word_regex(p: str) -> str:
    """A Java regex matching ``p`` literally, not inside a longer word (Unicode word characters)."""
    return r"(?U)(?<!\w)\Q" + p.replace(r"\E", r"\E\\E\Q") + r"\E(?!\w)"


def sql_has(x: str, p: str, word_boundary: bool = False) -> str:
    """Substring test (the reference's rule), or a whole-word test when asked."""
    if word_boundary:
        return f"({x} RLIKE {sql_str(word_regex(p))})"
    return f"contains({x}, {sql_str(p)})"


def sql_any(x: str, pats, word_boundary: bool = False) -> str:
    """True when any pattern is a substring of ``x`` (NULL ``x`` -> false)."""
    pats = list(pats)
    if not pats:
        return "false"
    return "coalesce(" + " OR ".join(sql_has(x, p, word_boundary) for p in pats) + ", false)"


def sql_first_index(x: str, pats, word_boundary: bool = False) -> str:
    """1-based index of the first pattern, in list order, contained in ``x``; NULL if none."""
    pats = list(pats)
    if not pats:
        return "CAST(NULL AS INT)"
    return "CASE " + " ".join(f"WHEN {sql_has(x, p, word_boundary)} THEN {i}" for i, p in enumerate(pats, 1)) + " END"


def sql_pick(values, idx: str) -> str:
    """values[idx - 1]; guarded, because element_at with a NULL index is not reliably NULL under codegen."""
    values = list(values)
    if not values:
        return "CAST(NULL AS STRING)"
    return f"CASE WHEN {idx} IS NOT NULL THEN element_at({sql_array(values)}, {idx}) END"
