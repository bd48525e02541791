"""Scalar column functions (JVM-side expressions, no UDFs)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _single_spaced(c: Column) -> Column:
    """No whitespace (in the sense of ``\\s``) but single spaces."""
    out = ~c.contains("  ")
    for mark in "\t\n\x0b\f\r":
        out = out & ~c.contains(mark)
    return out


# X1 ----------------------------------------------------------------------------------------
def label_safe_name(col: Column | str) -> Column:
    """Collapse whitespace, trim, turn comma separators into spaces, upper-case.

    The patterns run only on texts that have a comma or other whitespace than single spaces.
    """
    c = F.trim(F.regexp_replace(_c(col), r"\s+", " "))
    c = F.regexp_replace(c, r"\s*,\s*", " ")
    c = F.regexp_replace(c, r"\s+", " ")
    plain = _single_spaced(_c(col)) & ~_c(col).contains(",")
    return F.upper(F.when(plain, F.trim(_c(col))).otherwise(c))


# X2 / X3 -----------------------------------------------------------------------------------
def normalize_text(col: Column | str) -> Column:
    """Trim, lower-case and collapse whitespace (Python ``" ".join(s.strip().casefold().split())``).

    The pattern runs only on texts with other whitespace than single spaces.
    """
    c = _c(col)
    return F.lower(F.when(_single_spaced(c), F.trim(c)).otherwise(F.trim(F.regexp_replace(c, r"\s+", " "))))


def normalize_id(col: Column | str) -> Column:
    return normalize_text(_c(col).cast("string"))


# P7 ----------------------------------------------------------------------------------------
def contains_any(col: Column | str, words: Iterable[str]) -> Column:
    """True when the lower-cased text contains any of ``words`` as a plain substring."""
    low = F.lower(_c(col))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def present(*cases: tuple[Column, Column]) -> Column:
    """The values (strings, not null) whose condition holds, in the given order.

    Unlike ``filter(array(when(...)))`` this holds no lambda, so Spark compiles it and evaluates common parts once.
    """
    empty = F.array().cast("array<string>")
    return F.concat(empty, *[F.when(cond, F.array(value)).otherwise(empty) for cond, value in cases])


# Pattern helpers ---------------------------------------------------------------------------
def ci(pattern: str) -> str:
    """Case-insensitive Java regex."""
    return "(?i)" + pattern


_LITERAL = re.compile(r"^[a-z0-9 %'&-]+$")


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case literals of which any match of ``pattern`` must contain at least one.

    Handles the shapes used by the knowledge tables: an optional leading word boundary or
    look-behind, then either a group of plain alternatives or a plain literal run. Returns
    None when no safe literal can be read off (the regex then runs unguarded).
    """
    p = pattern
    for head in (r"\b", r"(?<![a-z0-9])"):
        if p.startswith(head):
            p = p[len(head):]
    m = re.match(r"^\((?:\?:)?([^()]*)\)([a-z0-9 %'&-]*)(.?)", p)
    if m:
        alts, suffix, nxt = m.group(1).split("|"), m.group(2), m.group(3)
        if nxt in ("?", "*", "{") and suffix:
            suffix = suffix[:-1]  # the suffix's last character is optional
        if alts and all(_LITERAL.match(a) for a in alts):
            return [(a + suffix).lower() for a in alts]
        return None
    m = re.match(r"^([a-z0-9%'&-]+)", p, flags=re.I)
    if m and len(m.group(1)) >= 2:
        lit = m.group(1)
        nxt = p[len(lit):len(lit) + 1]
        if nxt in ("?", "*", "{"):  # the last character is optional
            lit = lit[:-1]
        return [lit.lower()] if len(lit) >= 2 else None
    return None


def may_match(low: Column, patterns: list[str]) -> Column:
    """False only where none of the patterns can match: no literal that they need is in the lower-cased text."""
    lits = [required_literals(p) for p in patterns]
    if not all(lits):
        return F.lit(True)
    out = F.lit(False)
    for lit in sorted({x for some in lits for x in some}):
        out = out | low.contains(lit)
    return out


def guarded_rlike(col: Column | str, pattern: str, low: Column | None = None) -> Column:
    """Case-insensitive ``rlike`` that first checks, with plain substring search on the
    lower-cased text, for a literal the pattern needs. Same result, far fewer regex scans
    over long texts."""
    c = _c(col)
    lits = required_literals(pattern)
    if not lits:
        return c.rlike(ci(pattern))
    low = F.lower(c) if low is None else low
    guard = None
    for lit in lits:
        g = low.contains(lit)
        guard = g if guard is None else guard | g
    return guard & c.rlike(ci(pattern))


def first_match(col: Column | str, patterns: list[tuple[str, str]], default=None) -> Column:
    """Label of the first (pattern, label) whose case-insensitive regex matches; else default.

    One scan tells whether any pattern can match at all, where each needs a literal.
    """
    c = _c(col)
    low = F.lower(c)
    out = None
    for pattern, label in patterns:
        cond = guarded_rlike(c, pattern, low)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    out = out.otherwise(F.lit(default))
    needed = [required_literals(pattern) for pattern, _ in patterns]
    if not all(needed):
        return out
    return F.when(low.rlike(any_keyword(x for some in needed for x in some)), out).otherwise(F.lit(default))


def matching_labels(col: Column | str, patterns: list[tuple[str, str]]) -> Column:
    """Array of labels (in the given order, duplicates kept) whose pattern matches."""
    c = _c(col)
    return F.filter(F.array(*[F.when(c.rlike(ci(p)), F.lit(l)) for p, l in patterns]),
                    lambda x: x.isNotNull())


def keyword_pattern(keyword: str) -> str:
    """Word-bounded keyword with an optional plural ``s`` (lookarounds, Java regex)."""
    esc = "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in keyword)
    return rf"(?<![a-z0-9]){esc}s?(?![a-z0-9])"


def keyword_alternation(keywords: list[str]) -> str:
    """One pattern for a label: any of its keywords, word-bounded, optional plural."""
    alts = "|".join("".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in k)
                    for k in sorted(keywords, key=len, reverse=True))
    return rf"(?<![a-z0-9])(?:{alts})s?(?![a-z0-9])"


def any_keyword(keywords: Iterable[str]) -> str:
    """A pattern that finds any of the keywords as a plain substring of lower-cased text."""
    by_first: dict[str, list[str]] = {}
    for k in sorted({k.lower() for k in keywords}):
        by_first.setdefault(k[:1], []).append(re.sub(r"([^\w\s])", r"\\\1", k[1:]))
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", first) + "(?:" + "|".join(rest) + ")" for first, rest in by_first.items())


# X5 ----------------------------------------------------------------------------------------
def fda_round(value: Column, zero_below: Column, fine_step: Column, fine_upto: Column,
              coarse_step: Column) -> Column:
    """Round a per-serving amount by its nutrient class (half-even to the step).

    Steps come from the rounding table; a nutrient without a row is left unrounded.
    """
    step = F.when(fine_upto.isNull() | (value <= fine_upto), fine_step).otherwise(coarse_step)
    inv = F.round(F.lit(1.0) / step)
    stepped = F.when(step >= 1, F.bround(value / step) * step).otherwise(F.bround(value * inv) / inv)
    return (F.when(fine_step.isNull(), value)
            .when(zero_below.isNotNull() & (value < zero_below), F.lit(0.0))
            .otherwise(stepped))


def fda_round_sql(value_sql: str, zero_below, fine_step, fine_upto, coarse_step) -> Column:
    """``fda_round`` with constant steps, built as one SQL expression (one parse); see ``half_even``."""
    def step(s):
        if s >= 1:
            return f"(rint(({value_sql}) / {float(s)!r}D) + 0.0D) * {float(s)!r}D"
        inv = float(round(1 / s))
        return f"(rint(({value_sql}) * {inv!r}D) + 0.0D) / {inv!r}D"
    parts = []
    if zero_below is not None:
        parts.append(f"WHEN ({value_sql}) < {float(zero_below)!r}D THEN 0.0D")
    if fine_upto is not None:
        parts.append(f"WHEN ({value_sql}) <= {float(fine_upto)!r}D THEN {step(fine_step)}")
        parts.append(f"ELSE {step(coarse_step)}")
    elif parts:
        parts.append(f"ELSE {step(fine_step)}")
    else:
        return F.expr(step(fine_step))
    return F.expr("CASE " + " ".join(parts) + " END")


def half_even(x: Column) -> Column:
    """``bround(x, 0)`` of a double without its decimal arithmetic: a double that ends in .5 is such a tie exactly, and -0.0 becomes 0.0."""
    return F.rint(x) + F.lit(0.0)


# X6 ----------------------------------------------------------------------------------------
def allergen_text(ordered: Column) -> Column:
    """Declaration text from allergens already in declaration order; null when empty."""
    up = F.transform(ordered, lambda a: F.upper(a))
    n = F.size(up)
    body = (F.when(n == 1, F.try_element_at(up, F.lit(1)))
            .when(n == 2, F.concat_ws(" and ", up))
            .otherwise(F.concat(F.array_join(F.slice(up, 1, n - 1), ", "), F.lit(" and "),
                                F.try_element_at(up, F.lit(-1)))))
    return (F.when(n == 0, F.lit(None).cast("string"))
            .when(F.length(body) < 80, F.concat(F.lit("CONTAINS: "), body))
            .otherwise(F.concat(F.lit("CONTAINS "), body)))


# X8 ----------------------------------------------------------------------------------------
def claim_type(text: Column | str, words: Iterable[str]) -> Column:
    return F.when(contains_any(text, words), F.lit("nutrient_content")).otherwise(F.lit("health"))


# X13 ---------------------------------------------------------------------------------------
def dv_text(dv: Column) -> Column:
    return F.when(dv.isNotNull(), F.concat(F.bround(dv, 0).cast("long").cast("string"), F.lit("%")))


# Python-compatible number formatting (%.0f / %.1f use half-even on the binary value) -------
# ``format_number`` is slow, so it gets only the negative, very large and not finite values, and ties of tenths (``fmt1``).
def _format_number(x: Column, pattern: str) -> Column:
    return F.replace(F.call_function("format_number", x, F.lit(pattern)), F.lit(","), F.lit(""))


def fmt0(x: Column) -> Column:
    return (F.when((x > 0) & (x < 1e15), F.rint(x).cast("bigint").cast("string"))
            .when(x == 0, F.substring_index(x.cast("double").cast("string"), ".", 1))
            .otherwise(_format_number(x, "0")))


def fmt1(x: Column) -> Column:
    # a tenth's rounding is certain where ten times the value is no tie, however the product is rounded
    tenths = x * 10.0
    sure = F.abs(tenths - F.floor(tenths) - 0.5) > 1e-6
    return (F.when((x > 0) & (x < 1e6) & sure, (F.rint(tenths) / 10.0).cast("string"))
            .when(x == 0, x.cast("double").cast("string"))
            .otherwise(_format_number(x, "0.0")))


# Word-set matching for \b(alt|alt)\b patterns ------------------------------------------------
_WORD_GROUP = re.compile(r"^\\b\(([a-z0-9 |]+)\)\\b$")


def word_tokens(col: Column | str) -> Column:
    """Distinct lower-cased maximal runs of word characters (letters, digits, underscore):
    exactly the runs a ``\\b...\\b`` match can cover."""
    return F.array_distinct(F.filter(F.split(F.lower(_c(col)), r"[^\p{L}\p{Nd}_]+"),
                                     lambda t: t != ""))


def word_group_match(col: Column | str, pattern: str, tokens: Column,
                     low: Column | None = None) -> Column | None:
    """For ``\\b(a|b|c d)\\b``: single-word alternatives are looked up in the text's word set;
    multi-word ones keep a guarded regex. None when the pattern has another shape."""
    m = _WORD_GROUP.match(pattern)
    if not m:
        return None
    alts = m.group(1).split("|")
    single = [a for a in alts if " " not in a]
    multi = [a for a in alts if " " in a]
    cond = F.arrays_overlap(tokens, F.array(*[F.lit(a) for a in single])) if single else F.lit(False)
    if multi:
        cond = cond | guarded_rlike(col, r"\b(" + "|".join(multi) + r")\b", low)
    return F.coalesce(cond, F.lit(False))


def first_match_words(col: Column | str, patterns: list[tuple[str, str]], tokens: Column,
                      default=None, low: Column | None = None) -> Column:
    """``first_match`` using a precomputed ``word_tokens`` column where the pattern allows;
    ``low`` (the lower-cased text, ideally its own column) feeds the literal guards."""
    c = _c(col)
    low = F.lower(c) if low is None else low
    out = None
    for pattern, label in patterns:
        cond = word_group_match(c, pattern, tokens, low)
        if cond is None:
            cond = guarded_rlike(c, pattern, low)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def ascii_word_tokens(col: Column | str) -> Column:
    """Distinct lower-cased runs of [a-z0-9]: the units a keyword bounded by
    ``(?<![a-z0-9])...(?![a-z0-9])`` can match."""
    return F.array_distinct(F.filter(F.split(F.lower(_c(col)), r"[^a-z0-9]+"), lambda t: t != ""))


def keyword_match(col: Column | str, keywords: list[str], tokens: Column) -> Column:
    """Any keyword (optional plural 's') as a whole [a-z0-9] word: one-word keywords by set
    lookup in ``ascii_word_tokens``, multi-word ones by a guarded regex."""
    single = [k for k in keywords if re.fullmatch(r"[a-z0-9]+", k)]
    multi = [k for k in keywords if k not in single]
    cond = (F.arrays_overlap(tokens, F.array(*[F.lit(w) for k in single for w in (k, k + "s")]))
            if single else F.lit(False))
    if multi:
        cond = cond | guarded_rlike(col, keyword_alternation(multi))
    return F.coalesce(cond, F.lit(False))
