"""Query templates: placeholders, markers, lint and previews.

Placeholders are written ``:name``, ``{#name}`` or ``${name}``. Column
functions work on a whole corpus of templates; the two plain-text helpers
prepare one template for ``spark.sql``.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from parampipe.functions import date_texts as D

# The three placeholder forms.
PLACEHOLDER_PATTERNS = (
    r"(?<!:):([A-Za-z_][A-Za-z0-9_]*)",
    r"\{#([A-Za-z_][A-Za-z0-9_]*)\}",
    r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}",
)

# Texts of the lint findings.
ISSUE_SEMICOLON = "ends with ';'"
ISSUE_SLASH = "contains '/'"
ISSUE_MISSING = "missing params "

# Fixed value: lines kept around a hit, and lines shown without any hit.
PREVIEW_CONTEXT = 5
PREVIEW_HEAD = 10

# The characters that count as white space around a statement.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def placeholder_names(text: Column) -> Column:
    """Sorted distinct placeholder names of a template text."""
    hits = [F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in PLACEHOLDER_PATTERNS]
    return F.array_sort(F.array_distinct(F.concat(*hits)))


def strip_end(text: Column) -> Column:
    """Statement without surrounding space and trailing ``;`` and ``/``."""
    return F.rtrim(F.ltrim(text, F.lit(WHITESPACE)), F.lit(WHITESPACE + ";/"))


def normalize(text: Column) -> Column:
    """Statement form used for hashing: trimmed, one ``;`` dropped, ``/`` lines removed."""
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    return F.replace(F.regexp_replace(trimmed, r";$", ""), F.lit("\n/"), F.lit("\n"))


def text_hash(text: Column) -> Column:
    return F.md5(text)


def lint_issues(text: Column, missing: Column) -> Column:
    """Findings of one template joined by ``; `` (empty text: none)."""
    quoted = F.transform(missing, lambda m: F.concat(F.lit("'"), m, F.lit("'")))
    return F.concat_ws(
        "; ",
        F.when(F.rtrim(text, F.lit(WHITESPACE)).endswith(";"), ISSUE_SEMICOLON),
        F.when(text.contains("\n/"), ISSUE_SLASH),
        F.when(
            F.size(missing) > 0,
            F.concat(F.lit(ISSUE_MISSING), F.lit("["), F.array_join(quoted, ", "), F.lit("]")),
        ),
    )


# a whole name: ``:a`` is not found in ``:a_b`` or ``:aé``
_ANY_PLACEHOLDER = (
    r"(?U)\$\{[A-Za-z_][A-Za-z0-9_]*\}|\{#[A-Za-z_][A-Za-z0-9_]*\}"
    r"|(?<!:):[A-Za-z_][A-Za-z0-9_]*\b"
)


def literal_pieces(text: Column) -> Column:
    """Texts between the placeholders, in order; one more than there are placeholders."""
    return F.split(text, _ANY_PLACEHOLDER, -1)


def placeholder_pieces(text: Column) -> Column:
    """The placeholders as written, in order, and an empty text at the end."""
    found = F.regexp_extract_all(text, F.lit(_ANY_PLACEHOLDER), F.lit(0))
    return F.concat(found, F.array(F.lit("")))


def render(literals: Column, placeholders: Column, params: Column) -> Column:
    """Template text with the raw values of `params` put in; unknown names stay as
    they are. The text is cut once, whatever the number of cases."""

    def filled(literal: Column, mark: Column) -> Column:
        value = F.try_element_at(params, F.translate(mark, ":{}#$", ""))
        return F.concat(literal, F.coalesce(value, mark))

    return F.array_join(F.zip_with(literals, placeholders, filled), "")


def plan_header(file_name: Column, params: Column) -> Column:
    """Comment block in front of a rendered statement; parameters in key order."""
    lines = F.transform(
        F.array_sort(F.map_keys(params)),
        lambda k: F.concat(F.lit("--   "), k, F.lit(" = "), F.element_at(params, k)),
    )
    return F.concat(
        F.lit("-- ======================================\n-- FILE: "),
        file_name,
        F.lit("\n-- PARAMS:\n"),
        F.array_join(lines, "\n"),
        F.lit("\n\n"),
    )


def text_lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n")


def hit_lines(lines: Column, values: Column) -> Column:
    """0-based numbers of the lines that hold one of `values`."""
    numbered = F.transform(
        lines, lambda line, i: F.when(F.exists(values, lambda v: F.contains(line, v)), i)
    )
    return F.array_compact(numbered)


def lines_around(lines: Column, hits: Column, context: int = PREVIEW_CONTEXT) -> Column:
    """Lines from `context` before the first hit to `context` after the last; the
    first lines when there is no hit."""
    start = F.greatest(F.array_min(hits) - context, F.lit(0))
    stop = F.least(F.array_max(hits) + context + 1, F.size(lines))
    shown = F.when(F.size(hits) == 0, F.slice(lines, 1, PREVIEW_HEAD)).otherwise(
        F.slice(lines, start + 1, stop - start)
    )
    return F.array_join(shown, "\n")


# --- one template, on its way into spark.sql -------------------------------

_NAME = r"[A-Za-z_][A-Za-z0-9_]*"
_BRACED = re.compile(rf"\{{#({_NAME})\}}|\$\{{({_NAME})\}}")
_MARKER = re.compile(rf"(?<!:):({_NAME})\b")
_WHOLE = re.compile(rf"\s*(?::({_NAME})|\{{#({_NAME})\}}|\$\{{({_NAME})\}})\s*")
# what a statement is made of besides code: comments (but no hints), literals, quoted names
_PIECE = re.compile(
    r"(?P<comment>--[^\n]*|/\*(?!\+).*?(?:\*/|\Z))"
    r"|(?P<literal>'(?:[^'\\]|\\.|'')*(?:'|\Z))"
    r"|(?P<quoted>\"(?:[^\"]|\"\")*(?:\"|\Z)|`(?:[^`]|``)*(?:`|\Z))",
    re.DOTALL,
)
_PLACEHOLDER = re.compile(rf"\{{#({_NAME})\}}|\$\{{({_NAME})\}}|(?<!:):({_NAME})\b")
_ANY = rf"(?:\{{#{_NAME}\}}|\$\{{{_NAME}\}}|(?<!:):{_NAME}\b)"
# a table name with a parameter in it
_TABLE = re.compile(
    rf"\b(FROM|JOIN|INTO|UPDATE|TABLE)(\s+)((?:[\w.]|{_ANY})*{_ANY}(?:[\w.]|{_ANY})*)", re.IGNORECASE
)
_EQUAL_BEFORE = re.compile(r"(?<![<>!=])=\s*$")
_EQUAL_JOINED = re.compile(r"(?<![<>!=])=\s*concat\([^()]*\)")
_EQUAL_AFTER = re.compile(r"\s*=(?!=)")
_NOT_CONJUNCTIVE = re.compile(r"\b(OR|NOT|CASE|UNION|EXCEPT|INTERSECT|MINUS)\b", re.IGNORECASE)
_MANY_TO_ONE = re.compile(
    r"\b(GROUP\s+BY|DISTINCT|HAVING|LIMIT|OVER|COUNT|SUM|AVG|MIN|MAX|UNION|EXCEPT|INTERSECT|JOIN)\b",
    re.IGNORECASE,
)


def pieces(statement: str) -> list[tuple[str, str]]:
    """The statement as (kind, text): ``code``, ``literal``, ``quoted`` or ``comment``."""
    found, at = [], 0
    for match in _PIECE.finditer(statement):
        if match.start() > at:
            found.append(("code", statement[at : match.start()]))
        found.append((match.lastgroup, match.group()))
        at = match.end()
    if at < len(statement):
        found.append(("code", statement[at:]))
    return found


def in_code(statement: str, change) -> str:
    """The statement with `change` applied to its code only."""
    return "".join(change(text) if kind == "code" else text for kind, text in pieces(statement))


def code_of(statement: str) -> str:
    return " ".join(text for kind, text in pieces(statement) if kind == "code")


def to_markers(template: str) -> str:
    """One spelling for all placeholders: ``:name`` outside of literals; no comments, no
    statement end.

    A literal that is nothing but a placeholder stands for its value; braced placeholders
    within a longer literal are put together with its text; any other ``:x`` in a literal
    is text. A table name with placeholders becomes an identifier made of its parts.
    """
    found = [(kind, " " if kind == "comment" else text) for kind, text in pieces(template)]
    while found:
        kind, text = found.pop()
        if kind in ("code", "comment"):
            text = text.rstrip(WHITESPACE + ";/")
        if text:
            found.append((kind, text))
            break
    out = []
    for kind, text in found:
        if kind == "literal":
            text = _literal(text)
        elif kind == "code":
            text = _TABLE.sub(lambda m: m.group(1) + m.group(2) + _identifier(m.group(3)), text)
            text = _BRACED.sub(lambda m: ":" + (m.group(1) or m.group(2)), text)
        out.append(text)
    return "".join(out).strip(WHITESPACE)


def _literal(text: str) -> str:
    inner = text[1:-1]
    if whole := _WHOLE.fullmatch(inner):
        return ":" + next(g for g in whole.groups() if g)
    return _joined(inner, _BRACED) if _BRACED.search(inner) else text


def _identifier(name: str) -> str:
    return f"IDENTIFIER({_joined(name, _PLACEHOLDER)})"


def _joined(text: str, placeholder: re.Pattern) -> str:
    parts, at = [], 0
    for match in placeholder.finditer(text):
        if match.start() > at:
            parts.append(f"'{text[at : match.start()]}'")
        parts.append(":" + next(g for g in match.groups() if g))
        at = match.end()
    if at < len(text):
        parts.append(f"'{text[at:]}'")
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"


def template_hash(template: str) -> str:
    """`text_hash` of the normalized template, for a single text."""
    text = template.strip(WHITESPACE).removesuffix(";").replace("\n/", "\n")
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def marker_names(statement: str) -> list[str]:
    return sorted(set(_MARKER.findall(code_of(statement))))


def table_names(statement: str) -> list[str]:
    """Parameters that are part of a table name."""
    found = re.findall(r"IDENTIFIER\(([^()]*(?:\([^()]*\))?)\)", statement)
    return sorted({n for text in found for n in _MARKER.findall(code_of(text))})


def replace_marker(statement: str, name: str, replacement: str) -> str:
    return in_code(statement, lambda t: re.sub(rf"(?<!:):{name}\b", lambda _m: replacement, t))


def unequal_markers(statement: str) -> list[str]:
    """Parameters used otherwise than in an equality or a range of date texts that every row
    must meet: the statement cannot be joined with a table of their values."""
    code = "".join(t if kind == "code" else t.replace(":", " ") for kind, t in pieces(statement))
    text = _EQUAL_JOINED.sub(" ", D.without_ranges(code))
    loose = set()
    for match in _MARKER.finditer(text):
        before, after = text[: match.start()], text[match.end() :]
        if not (_EQUAL_BEFORE.search(before) or _EQUAL_AFTER.match(after)):
            loose.add(match.group(1))
    names = marker_names(statement)
    if has_choices(statement):
        return names
    return sorted(loose.intersection(names))


def has_choices(statement: str) -> bool:
    """The statement has a word that makes a condition one of several, or a set operation."""
    return bool(_NOT_CONJUNCTIVE.search(code_of(statement)))


def keeps_rows_apart(statement: str) -> bool:
    """Every result row comes from one row of one table, so cases may be cut into months."""
    return not _MANY_TO_ONE.search(code_of(statement))
