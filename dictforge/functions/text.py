"""Text functions, Column to Column.

Java regex classes are ASCII unless told otherwise, dictionary text is not: ``\\p{Nd}`` and the
explicit letter classes below give the Unicode meaning.
"""

from __future__ import annotations

import functools
import html
import html.entities
import json
import unicodedata
from collections.abc import Callable, Iterator
from string import Formatter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Runs of white space other than a single U+0020, which collapsing leaves as it is.
SPACE_TO_COLLAPSE = r"(?U)[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*| [\s\x1c-\x1f]+"
WHITE_SPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
WHOLE_WORD_NAN = r"(?<![\p{L}\p{N}_])nan(?![\p{L}\p{N}_])"
MAYBE_ENTITY = r"&[^\t\n\f <&;]"
# A tag with its attributes; a ``>`` inside quotes does not end it.
_ATTRIBUTES = r"""(?:"[^"]*"|'[^']*'|[^'">])*+>"""
# Comments and hidden bodies that are never closed reach to the end, as a parser reads them.
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b" + _ATTRIBUTES + r".*?(?:</\1\s*>|\z)|</?[a-z!?]" + _ATTRIBUTES
)
LAST_SEQUENCE = 999999

_NON_ASCII_DIGITS = "".join(
    chr(c) for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) == "Nd"
)
_DIGIT_VALUES = "".join(str(unicodedata.decimal(c)) for c in _NON_ASCII_DIGITS)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_blank(c: Column) -> Column:
    """Null and empty alike, as a falsy value."""
    return text_or_empty(c) == ""


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(c, SPACE_TO_COLLAPSE, " ")


# Between the names and texts of the entity table; neither can stand in a name.
_NAME, _TEXT = "\x01", "\x02"
# Names met often are looked up apart from the others.
_COMMON = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;")


@functools.cache
def _entities() -> tuple[str, str, str, list[int]]:
    """The standard library's tables: named entities, one after the other in one text, which costs a plan less than a map;
    what broken numbers stand for, as JSON; the names that need no semicolon, longest first, as a pattern; and
    the numbers that stand for nothing."""
    table = "".join(f"{_NAME}{name}{_TEXT}{text}" for name, text in html.entities.html5.items()) + _NAME
    bare = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
    numbers = {str(n): text for n, text in html._invalid_charrefs.items()}
    return table, json.dumps(numbers), f"^({'|'.join(bare)})", sorted(html._invalid_codepoints)


def _reference(part: Column, bare_names: bool = True) -> Column:
    """What follows an ``&``, with the reference it may begin with undone; without ``bare_names`` only a closed one."""
    table, numbers, bare, nothing = _entities()
    broken = F.from_json(F.lit(numbers), "map<string,string>")

    def lookup(name: Column) -> Column:
        def found(at: Column) -> Column:
            text = F.substring(F.lit(table), at + F.length(name) + len(_NAME + _TEXT), F.lit(8))
            return F.when(at > 0, F.substring_index(text, _NAME, 1))

        common = F.lit(None).cast("string")
        for known in _COMMON:
            common = F.when(name == known, html.entities.html5[known]).otherwise(common)
        place = F.instr(F.lit(table), F.concat(F.lit(_NAME), name, F.lit(_TEXT)))
        rare = F.when(F.rlike(name, F.lit("^[A-Za-z0-9]+;?$")), let(place, found))
        return F.coalesce(common, rare)

    def closed(mark: Column, undone: Column) -> Column:
        if bare_names:
            return undone
        return F.when(F.endswith(mark, F.lit(";")), undone).otherwise(F.concat(F.lit("&"), part))

    def named(name: Column) -> Column:
        if not bare_names:
            text = F.coalesce(lookup(name), F.concat(F.lit("&"), name))
            return closed(name, F.concat(text, F.substring(part, F.length(name) + 1, F.length(part))))
        # A name that is none may begin with one of those that need no semicolon.
        begins = F.regexp_extract(name, bare, 0)
        rest = F.substring(name, F.length(begins) + 1, F.length(name))
        short = F.when(begins != "", F.concat(lookup(begins), rest))
        whole = F.coalesce(lookup(name), short, F.concat(F.lit("&"), name))
        return F.concat(whole, F.substring(part, F.length(name) + 1, F.length(part)))

    def numeric(mark: Column) -> Column:
        hexadecimal = F.rlike(mark, F.lit("^#[xX]"))
        digits = F.regexp_replace(mark, "^#[xX]?0*|;$", "")
        number = F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(
            F.coalesce(
                F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"), F.lit(0)
            )
        )

        def text(n: Column) -> Column:
            unknown = (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
            letter = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
            return (
                F.when(unknown, "\ufffd")
                .when(n < 256, F.coalesce(F.try_element_at(broken, n.cast("string")), F.when(n.isin(nothing), "").otherwise(letter)))
                .when(n.isin(nothing), "").otherwise(letter)
            )

        return closed(mark, F.concat(let(number, text), F.substring(part, F.length(mark) + 1, F.length(part))))

    mark = F.regexp_extract(part, r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?)", 0)
    name = F.regexp_extract(part, r"^[^\t\n\f <#;]{1,32};?", 0)
    return (
        F.when(F.startswith(part, F.lit("#")), let(mark, lambda m: F.when(m == "", F.concat(F.lit("&"), part)).otherwise(numeric(m))))
        .otherwise(let(name, lambda m: F.when(m == "", F.concat(F.lit("&"), part)).otherwise(named(m))))
    )


def _undone(c: Column, bare_names: bool = True) -> Column:
    """Every part after an ``&`` stands for itself, so a text is cut there and joined again."""
    def reference(part: Column) -> Column:
        return _reference(part, bare_names)

    parts = F.split(c, "&")
    return let(parts, lambda p: F.concat(
        F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, 2, F.size(p)), reference), "")
    ))


def unescaped(c: Column, bare_names: bool = True) -> Column:
    """Text of rows that may hold an entity with its entities undone, null for the others."""
    return F.when(F.contains(c, F.lit("&")) & F.rlike(c, F.lit(MAYBE_ENTITY)), _undone(c, bare_names))


def unescape_html(c: Column, bare_names: bool = True) -> Column:
    """HTML entities to text. Without ``bare_names`` one that lacks its semicolon, as where a text was cut, stays."""
    return F.coalesce(unescaped(c, bare_names), c)


def normalize(c: Column) -> Column:
    """One-line form of a dictionary text: entities, spacing, spaced numbers, doubled marks, plus signs."""
    return normalize_unescaped(unescape_html(text_or_empty(c)))


def normalize_unescaped(c: Column) -> Column:
    """The native part of ``normalize``, for texts whose entities are undone."""
    # Most texts need none of the replacements, so each is tried only where its marks occur.
    def spaced_numbers(t: Column) -> Column:
        return F.when(F.contains(t, F.lit(", ")), F.regexp_replace(t, r"(\p{Nd}), (\p{Nd})", "$1,$2")).otherwise(t)

    def doubled_marks(t: Column) -> Column:
        doubled = F.contains(t, F.lit("..")) | F.contains(t, F.lit(",,"))
        return F.when(doubled, F.regexp_replace(t, r"([.,])\1+", "$1")).otherwise(t)

    text = let(let(collapse_space(c), spaced_numbers), doubled_marks)
    return F.trim(F.replace(text, F.lit("+"), F.lit(" ")))


def html_to_text(c: Column, bare_names: bool = True) -> Column:
    """Visible text of an HTML fragment whose markup may itself be escaped once; ``bare_names`` as in ``unescape_html``."""
    text = F.regexp_replace(unescape_html(text_or_empty(c), bare_names), MARKUP, " ")
    return F.trim(collapse_space(unescape_html(text, bare_names)))


def reference_codes(c: Column, regex: str) -> Column:
    """All ``(InternalCode, ReferenceCode)`` links of a raw text, in order of appearance."""
    return F.transform(
        F.regexp_extract_all(text_or_empty(c), F.lit(regex), F.lit(0)),
        lambda m: F.struct(
            F.regexp_extract(m, regex, 1).alias("InternalCode"),
            F.regexp_replace(F.regexp_extract(m, regex, 2), r"\.+$", "").alias("ReferenceCode"),
        ),
    )


def clean_word_list(c: Column) -> Column:
    """``a| b ,, c`` to ``a, b, c``; null when nothing is left."""
    words = F.filter(F.transform(F.split(F.translate(c, "|", ","), ","), strip), lambda w: w != "")
    return F.when(F.size(words) > 0, F.array_join(words, ", "))


def has_list_items(c: Column) -> Column:
    """Whether ``clean_word_list`` leaves anything, told without cleaning."""
    return F.btrim(c, F.lit(WHITE_SPACE + "|,")) != ""


def label_tokens(label: Column, split_regex: str, exclude_keywords: tuple[str, ...]) -> Column:
    """Tags named by a type or gender label."""

    def keep(token: Column) -> Column:
        wanted = token != ""
        for keyword in exclude_keywords:
            wanted = wanted & ~F.contains(F.lower(token), F.lit(keyword))
        return wanted

    return F.filter(F.transform(F.split(text_or_empty(label), split_regex), strip), keep)


def managed_types(type_tokens: Column, gender_tokens: Column) -> Column:
    """Sorted distinct tags of the tokens of a type and of a gender."""
    none = F.array().cast("array<string>")
    tokens = F.concat(F.coalesce(type_tokens, none), F.coalesce(gender_tokens, none))
    return F.array_sort(F.array_distinct(tokens))


def sequence_key(seq_no: Column, regex: str = r"\p{Nd}+") -> Column:
    """First number of a sequence text in any script; without one, behind all numbered meanings."""
    digits = F.translate(
        F.regexp_extract(text_or_empty(seq_no), regex, 0), _NON_ASCII_DIGITS, _DIGIT_VALUES
    )
    return (
        F.when(digits == "", F.lit(LAST_SEQUENCE).cast("long"))
        .otherwise(F.coalesce(digits.try_cast("long"), F.lit((1 << 63) - 1)))
    )


def regex_literal(c: Column) -> Column:
    """Escape a text for use as a regex replacement."""
    return F.regexp_replace(c, r"([\\$])", r"\\$1")


def substitute_suffix(text: Column, word: Column, regex: str) -> Column:
    """Sub-entries written as a mark plus suffix become the word plus suffix."""
    return F.regexp_replace(text, F.lit(regex), F.concat(regex_literal(word), F.lit("$1")))


def suffixes(text: Column, regex: str) -> Column:
    return F.regexp_extract_all(text, F.lit(regex), F.lit(1))


def split_example(text: Column, regex: str) -> tuple[Column, Column]:
    """Text before the first example mark and, where there is one, the example behind it."""
    halves = F.split(text, regex, 2)
    # The search keeps its compiled pattern; the split, which does not, runs on texts with a mark only.
    found = F.rlike(text, F.lit(regex))
    return (
        F.when(found, strip(F.get(halves, F.lit(0)))).otherwise(text),
        F.when(found, strip(F.get(halves, F.lit(1)))),
    )


def quoted_usages(text: Column, regex: str) -> Column:
    return F.transform(
        F.regexp_extract_all(text, F.lit(regex), F.lit(0)),
        lambda m: F.concat(
            F.lit('"'),
            strip(F.regexp_extract(m, regex, 1)),
            F.lit('" - Source: '),
            strip(F.regexp_extract(m, regex, 2)),
        ),
    )


def without_quoted_usages(text: Column, regex: str) -> Column:
    return strip(F.regexp_replace(text, regex, ""))


def is_valid_target(
    c: Column, blocked_texts: tuple[str, ...], min_chars: int = 5, max_chars: int = 10000
) -> Column:
    """False for empty, runaway or placeholder texts. The length limits cut most cases before the regex."""
    text = text_or_empty(c)

    def unusable(lowered: Column) -> Column:
        found = F.contains(lowered, F.lit("nan")) & F.rlike(lowered, F.lit(WHOLE_WORD_NAN))
        for blocked in blocked_texts:
            found = F.contains(lowered, F.lit(blocked)) | found
        return found

    fits = (F.length(text) <= max_chars) & (F.length(strip(text)) >= min_chars)
    return fits & ~let(F.lower(text), unusable)


def concept_key(prompt: Column, target: Column) -> Column:
    """Hash of the prompt and the first 500 characters of the target."""
    return F.md5(strip(F.concat(prompt, F.lit("|"), F.substring(target, 1, 500))))


def render(template: str, **values: Column) -> Column:
    """Fill a ``{name}`` template. The template is cut on the driver, user text is only concatenated."""
    pieces: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name:
            pieces.append(values[name])
    return F.concat(*pieces)


def closing_tail(template: str) -> str:
    return template.split("{target}")[-1] if "{target}" in template else " </s>"


def truncate_record(c: Column, template: str, max_length: int) -> Column:
    """Cut an over-long record but keep the closing part of its template."""
    tail = closing_tail(template)
    head = F.substring(c, 1, max_length - len(tail) - 5)
    return F.when(F.length(c) > max_length, F.concat(head, F.lit(" ... " + tail))).otherwise(c)


def language_code(c: Column) -> Column:
    return F.upper(F.substring_index(c, ".", -1))


def part_marker(part_index: Column, total_parts: Column) -> Column:
    return F.when(
        part_index.isNotNull(),
        F.concat(F.lit(" ("), part_index.cast("string"), F.lit("/"), total_parts.cast("string"), F.lit(")")),
    ).otherwise("")


def mask_secret(c: Column) -> Column:
    """First four characters, stars, last four."""
    stars = F.repeat(F.lit("*"), F.greatest(F.length(c) - 8, F.lit(0)))
    return F.concat(F.substring(c, 1, 4), stars, F.right(c, F.lit(4)))


def snippet(c: Column, chars: int = 500) -> Column:
    return F.substring(c, 1, chars)


def path_safe(c: Column) -> Column:
    return F.translate(c, "/", "_")
