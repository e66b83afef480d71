"""Text functions: stripping, tokens, vocabulary matching, unwrapping.

Small functions take and return columns. Expressions generated from a vocabulary
are built as SQL text: they have many nodes, and a Python call per node would
take longer than a query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagwright.vocabulary import NOT_MENTIONED

# Every character that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

EXACT, FUZZY, UNKNOWN = "exact", "fuzzy", "oov"


# ---- SQL text ---------------------------------------------------------------


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(column: str) -> str:
    """A SQL column name."""
    return "`" + column.replace("`", "``") + "`"


def blank_sql(cell: str) -> str:
    """True for NULL and for text with nothing but whitespace."""
    return f"coalesce(trim(LEADING {quoted(WHITESPACE)} FROM {cell}) = '', true)"


def filled(cell: str, default: str = NOT_MENTIONED) -> str:
    """NULL or empty text becomes ``default``; whitespace alone is left as it is."""
    return f"coalesce(nullif({cell}, ''), {quoted(default)})"


def normal_form(cell: str) -> str:
    """Stripped, lower case, with ``_`` for spaces and hyphens."""
    # In printable ASCII the only whitespace is the space, which Spark trims much faster than a set.
    other = f"{cell} RLIKE '[^ -~]'"
    every = f"trim(BOTH {quoted(WHITESPACE)} FROM {cell})"
    stripped = f"CASE WHEN {other} THEN {every} ELSE trim({cell}) END"
    return f"replace(replace(lower({stripped}), ' ', '_'), '-', '_')"


def normal_form_of(cell: str, values: Sequence[str]) -> str:
    """``normal_form``, but cells that are a vocabulary value already are not worked on."""
    ready = [v for v in values if v and v == v.strip().lower() and not set(v) & set(" -,")]
    if not ready:
        return normal_form(cell)
    known = ", ".join(map(quoted, ready))
    return f"CASE WHEN {cell} IN ({known}) THEN {cell} ELSE {normal_form(cell)} END"


def tokens(cell: str) -> str:
    """``"Turn Left, u-turn"`` → ``["turn_left", "u_turn"]``; never an empty array."""
    return f"transform(split({cell}, ',', -1), part -> {normal_form('part')})"


def _exact_or_blank(token: str, values: Sequence[str]) -> str:
    blank = NOT_MENTIONED if NOT_MENTIONED in values else values[0]
    known = ", ".join(map(quoted, values))
    return f"CASE WHEN {token} IN ({known}) THEN {token} WHEN {token} = '' THEN {quoted(blank)}"


def nearest(token: str, values: Sequence[str]) -> str:
    """The vocabulary value for a token, or NULL.

    An exact value wins. Otherwise the first value, in vocabulary order, that
    contains the token or is contained in it. A blank token counts as not mentioned.
    """
    alike = " ".join(
        f"WHEN contains({v}, {token}) OR contains({token}, {v}) THEN {v}" for v in map(quoted, values)
    )
    return f"{_exact_or_blank(token, values)} {alike} END"


def judged(field: str, token: str, hit: str) -> str:
    """``STRUCT<field, token, outcome, value>``; a token without a hit keeps its own text."""
    return (
        f"named_struct('field', {quoted(field)}, 'token', {token}, 'outcome', "
        f"CASE WHEN {hit} = {token} THEN '{EXACT}' WHEN {hit} IS NOT NULL THEN '{FUZZY}' "
        f"ELSE '{UNKNOWN}' END, 'value', coalesce({hit}, {token}))"
    )


def judged_tokens(cell: str, field: str, values: Sequence[str]) -> str:
    """``ARRAY`` of ``judged``, one element per token of the cell."""
    known = ", ".join(map(quoted, values))
    alike = f"filter(array({known}), v -> contains(v, token) OR contains(token, v))"
    hit = f"{_exact_or_blank('token', values)} ELSE try_element_at({alike}, 1) END"
    pairs = f"transform({tokens(cell)}, token -> named_struct('token', token, 'hit', {hit}))"
    return f"transform({pairs}, pair -> {judged(field, 'pair.token', 'pair.hit')})"


NO_OUTCOMES = (
    "CAST(array() AS ARRAY<STRUCT<field: STRING, token: STRING, outcome: STRING, value: STRING>>)"
)


def warning_text(outcome: str) -> str:
    # The two warning formats.
    fuzzy = f"concat({outcome}.field, ': \\'', {outcome}.token, '\\' → fuzzy matched to \\'', {outcome}.value, '\\'')"
    unknown = f"concat({outcome}.field, ': \\'', {outcome}.token, '\\' NOT in vocabulary')"
    return f"CASE {outcome}.outcome WHEN '{FUZZY}' THEN {fuzzy} ELSE {unknown} END"


# ---- columns again ----------------------------------------------------------


# One quoted text, a list of them, and a list of lists. Possessive parts keep long texts off Java's stack.
_TEXT = r"""(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")"""
_TEXTS = rf"\[\s*+(?:{_TEXT}\s*+(?:,\s*+{_TEXT}\s*+)*+)?+\]"
_LISTS = rf"(?s)^\s*+\[\s*+{_TEXTS}\s*+(?:,\s*+{_TEXTS}\s*+)*+\]\s*+$"


def _plain(literal: str) -> str:
    """A quoted text without quotes and escapes: those of quotes, backslash, line ends, tab, and ``\\x``, ``\\u``."""
    inner = f"substring({literal}, 2, length({literal}) - 2)"
    # As JSON text: backslashes that stand for themselves are set aside while the other escapes are rewritten.
    aside = f"replace({inner}, {quoted(chr(92) * 2)}, '\\u0001')"
    json = f"replace(replace({aside}, {quoted(chr(92) + chr(39))}, {quoted(chr(39))}), {quoted(chr(92) + chr(34))}, '\\u0002')"
    json = f"replace(replace({json}, '\"', {quoted(chr(92) + chr(34))}), '\\u0002', {quoted(chr(92) + chr(34))})"
    json = f"regexp_replace({json}, {quoted(chr(92) * 2 + 'x([0-9a-fA-F]{2})')}, {quoted(chr(92) * 2 + 'u00$1')})"
    json = f"replace(replace(replace({json}, chr(10), {quoted(chr(92) + 'n')}), chr(9), {quoted(chr(92) + 't')}), chr(13), {quoted(chr(92) + 'r')})"
    json = f"replace({json}, '\\u0001', {quoted(chr(92) * 2)})"
    read = f"from_json(concat('[\"', {json}, '\"]'), 'array<string>')[0]"
    return f"CASE WHEN contains({inner}, {quoted(chr(92))}) THEN coalesce({read}, {inner}) ELSE {inner} END"


def unwrapped_sql(cell: str) -> str:
    """``[['text']]`` → ``text``; anything else is left as it is.

    A text printed with its escapes is read with them. Lists of several texts stay as they are. What is left between the
    first and the last quote of ``[['`` and ``']]``, the same character, is one text that was wrapped without
    escapes: it is taken as it stands, quotes, backslashes and line ends included.
    """
    one = rf"(?s)^\s*+\[\s*+\[\s*+({_TEXT})\s*+\]\s*+\]\s*+$"
    literal = f"regexp_extract({cell}, {quoted(one)}, 1)"
    bare = " OR ".join(
        f"(startswith({cell}, {quoted('[[' + q)}) AND endswith({cell}, {quoted(q + ']]')}) AND length({cell}) >= 6)" for q in "'\""
    )
    return (
        f"CASE WHEN NOT startswith({cell}, '[') THEN {cell} WHEN {cell} RLIKE {quoted(one)} THEN {_plain(literal)} "
        f"WHEN ({bare}) AND NOT {cell} RLIKE {quoted(_LISTS)} THEN substring({cell}, 4, length({cell}) - 6) ELSE {cell} END"
    )


def samples_sql(cell: str) -> str:
    """``ARRAY<ARRAY<STRING>>`` of a printed list of lists of texts, such as ``[['a', "b's"], ['c']]``.

    NULL for anything else. Either quote character may be used, and escapes are undone.
    """
    lists = f"regexp_extract_all({cell}, {quoted(_TEXTS)}, 0)"
    each = f"transform(regexp_extract_all(x, {quoted(_TEXT)}, 0), y -> {_plain('y')})"
    return f"CASE WHEN {cell} RLIKE {quoted(_LISTS)} THEN transform({lists}, x -> {each}) END"


def unwrapped(col: str) -> Column:
    """``unwrapped_sql`` of a column."""
    return F.expr(unwrapped_sql(named(col)))


def samples(col: str) -> Column:
    """``samples_sql`` of a column."""
    return F.expr(samples_sql(named(col)))
