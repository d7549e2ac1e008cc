"""Text expressions. Everything here stays inside the JVM: no Python worker is started."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters trimmed from stored strings.
BLANKS = " \t\n\r\0\x0b"

# Unicode white space: a run, or one that is not already a plain blank. A single blank
# between words does not match, so ordinary prose has nothing to replace.
WHITESPACE = r"(?U)\s(?:\s+|(?<! ))"
# White space to some regular expressions and not to Java's.
VOWEL_SEPARATOR = "\u180e"
# The whole set spelled out, for engines whose ``\s`` is ASCII.
WHITESPACE_PORTABLE = (
    r"[\s\x0B\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def null_if_blank(text: Column) -> Column:
    return F.when(text != "", text)


def _tag_pattern(loop: str = "*+", run: str = "++") -> str:
    """Markup as one regular expression.

    A tag opens at ``<`` followed by anything but white space and closes at the first ``>``
    outside quotes; ``<`` inside a tag nests (two levels are spelled out here, what is
    deeper is walked); a comment
    closes at ``-->``; what never closes runs to the end of the text. The loops are
    possessive, so Java matches them without recursion however long the text is. Quotes are
    written as codes, so that the text can stand in an SQL string.
    """
    quoted = r"\x22[^\x22]*(?:\x22|\z)|\x27[^\x27]*(?:\x27|\z)"
    plain = rf"[^<>\x22\x27]{run}"
    inner = rf"<[^\s<>\x22\x27](?:{plain}|{quoted}|<\s){loop}(?:>|\z)"
    nested = rf"<[^\s<>\x22\x27](?:{plain}|{quoted}|<\s|{inner}){loop}(?:>|\z)"
    comment = r"!--(?:-?>|[\s\S]*?(?:-->|\z))"
    tag = rf"(?:[^\s<>\x22\x27]|{quoted})(?:{plain}|{quoted}|<\s|{nested}){loop}(?:>|\z)"
    simple = rf"[^\s<>\x22\x27!][^<>\x22\x27]*{run[1:]}>"  # most tags, without the general loop
    return rf"<(?:{simple}|{comment}|>|{tag})"


TAGS = _tag_pattern()
# The same expression for engines whose regular expressions have no possessive loops.
TAGS_PORTABLE = _tag_pattern("*", "+")


# Markup removed by counting, a token for each ``<``, ``>`` or quote: what nests deeper than the
# pattern spells out. Quotes are written as codes.
_WALK_START = "named_struct('out', '', 'depth', 0, 'quote', '', 'tail', '')"
_WALK_STEP = r"""CASE
  WHEN s.depth = 0 AND (left(t, 1) <> '<' OR t RLIKE '^<\\s') THEN named_struct('out', s.out || t, 'depth', 0, 'quote', '', 'tail', '')
  WHEN s.depth = 0 THEN named_struct('out', s.out, 'depth', 1, 'quote', CASE WHEN startswith(t, '<!--') THEN '-' ELSE '' END, 'tail', right(t, 2))
  WHEN s.quote = '-' AND left(t, 1) = '>' AND s.tail = '--' THEN named_struct('out', s.out || substring(t, 2), 'depth', 0, 'quote', '', 'tail', '')
  WHEN s.quote = '-' THEN named_struct('out', s.out, 'depth', s.depth, 'quote', '-', 'tail', right(t, 2))
  WHEN s.quote <> '' THEN named_struct('out', s.out, 'depth', s.depth, 'quote', CASE WHEN left(t, 1) = s.quote THEN '' ELSE s.quote END, 'tail', '')
  WHEN left(t, 1) IN (chr(34), chr(39)) THEN named_struct('out', s.out, 'depth', s.depth, 'quote', left(t, 1), 'tail', '')
  WHEN left(t, 1) = '<' AND NOT t RLIKE '^<\\s' THEN named_struct('out', s.out, 'depth', s.depth + 1, 'quote', '', 'tail', '')
  WHEN left(t, 1) = '>' AND s.depth = 1 THEN named_struct('out', s.out || substring(t, 2), 'depth', 0, 'quote', '', 'tail', '')
  WHEN left(t, 1) = '>' THEN named_struct('out', s.out, 'depth', s.depth - 1, 'quote', '', 'tail', '')
  ELSE s END"""


def _without_tags(spaced: str) -> str:
    """One pattern for nearly all texts; one that keeps an opened tag after it nests deeper and is walked."""
    walk = f"aggregate(split(markup, r'(?=[<>\\x22\\x27])'), {_WALK_START}, (s, t) -> {_WALK_STEP}, s -> s.out)"
    chosen = _bound(f"regexp_replace(markup, r'{TAGS}', '')", "bare", f"CASE WHEN bare RLIKE r'<\\S' THEN {walk} ELSE bare END")
    return _bound(spaced, "markup", chosen)


def _entity_table() -> str:
    """Named HTML5 references that end in ``;``, as JSON: name -> characters."""
    frequent = ["amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "trade", "middot", "ndash", "mdash"]
    known = {name[:-1]: chars for name, chars in html.entities.html5.items() if name.endswith(";")}
    ordered = {name: known[name] for name in frequent}
    ordered.update(known)
    return json.dumps(ordered, ensure_ascii=True)


# A numeric reference ``name``, which starts with ``#``, as a character; null where HTML5
# does not allow the number.
_NUMBER = """coalesce(
  try_cast(CASE WHEN name RLIKE '^#0*[0-9]{1,7}$' THEN substring(name, 2) END AS BIGINT),
  try_cast(CASE WHEN name RLIKE '^#[xX]0*[0-9a-fA-F]{1,6}$' THEN conv(substring(name, 3), 16, 10) END AS BIGINT))"""
_ALLOWED = """cp BETWEEN 32 AND 126 OR cp IN (9, 10, 12) OR cp BETWEEN 160 AND 55295
  OR (cp BETWEEN 57344 AND 1114111 AND cp & 65535 NOT IN (65534, 65535) AND cp NOT BETWEEN 64976 AND 65007)"""


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _decode_sql(text: str) -> str:
    """Replace character references in one pass, so ``&amp;lt;`` becomes ``&lt;``.

    The text is cut at every ``&``; each piece is looked up by what stands before its
    first ``;``. An unknown name stays as it was written.
    """
    table = "from_json(r'" + _entity_table().replace("'", "\\u0027") + "', 'map<string,string>')"
    number = _bound(_NUMBER, "cp", f"CASE WHEN {_ALLOWED} THEN decode(unhex(lpad(hex(cp), 8, '0')), 'UTF-32') END")
    chars = f"CASE WHEN startswith(name, '#') THEN {number} ELSE try_element_at({table}, name) END"
    stop = "instr(piece, ';')"
    name = f"CASE WHEN {stop} > 1 THEN substring(piece, 1, {stop} - 1) END"
    resolved = f"coalesce({_bound(name, 'name', chars)} || substring(piece, {stop} + 1), '&' || piece)"
    pieces = f"transform(split(written, '&'), (piece, at) -> CASE WHEN at = 0 THEN piece ELSE {resolved} END)"
    return _bound(text, "written", f"CASE WHEN contains(written, '&') THEN array_join({pieces}, '') ELSE written END")


def decode_entities(text: str) -> Column:
    """``text``, an SQL expression, with its character references replaced."""
    return F.expr(_decode_sql(text))


def plain_text(markup: str) -> Column:
    """``markup``, an SQL expression, as words: tags become blanks, references are decoded
    after that, white space collapses. ``<li>Cotton</li><li>Wash</li>`` keeps its two
    words apart. Written as one SQL text, which Spark parses at once."""
    spaced = f"replace(replace(replace({markup}, '<', ' <'), '>', '> '), '\\0', '')"
    decoded = f"replace({_decode_sql(_without_tags(spaced))}, '{VOWEL_SEPARATOR}', ' ')"
    return F.expr(f"trim(regexp_replace({decoded}, r'{WHITESPACE}', ' '))")


def split_values(stored: Column) -> Column:
    """A comma list as an array, trimmed, without blanks, in stored order."""
    return F.filter(F.transform(F.split(stored, ","), trimmed), lambda part: part != "")


def label_or_code(store_label: Column, admin_label: Column, code: Column) -> Column:
    return F.coalesce(null_if_blank(store_label), null_if_blank(admin_label), code)
