"""Text cleaning and lexical functions.

Character classes follow Python's ``unicodedata`` (``str.isprintable``,
``isspace``, ``isdigit`` and regex ``\\w``).  The JVM's Unicode tables may be
older, so every class has two parts: the JVM's own categories, which are fast,
and ``\\p{Cn}`` narrowed to what Python says.  The second part is only looked at
for characters the JVM does not know.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions.binding import let
from vecloom.functions.slices import in_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The patterns and strip characters that define the cleaning result.
HTML_TAG = r"<[^>]+>"
MARKDOWN_LINK = r"\[([^\]]+)\]\([^\)]+\)"
MARKDOWN_SYMBOLS = r"[*_~`#>]"
BLANK_RUN = r"[ \t]+"
NEWLINE_RUN = r"\n{3,}"
STRIPPED = " \n\r\t"
ASCII_CONTROLS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"

# Symbols turn into blanks and runs of blanks then collapse; one pass does both. A single
# blank would be replaced by itself, so it is no match.
SYMBOL_OR_BLANK_RUN = r"[*_~`#>\t][*_~`#> \t]*| [*_~`#> \t]+"


def _runs(wanted) -> list[tuple[int, int]]:
    """First and last of every run of code points for which ``wanted`` holds."""
    runs, first = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and wanted(chr(code))
        if inside and first is None:
            first = code
        elif not inside and first is not None:
            runs.append((first, code - 1))
            first = None
    return runs


def _body(runs: list[tuple[int, int]]) -> str:
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)


def _ranges(wanted) -> str:
    """Regex class body listing every code point for which ``wanted`` holds."""
    return _body(_runs(wanted))


def _nested(runs: list[tuple[int, int]], width: int = 8) -> str:
    """Regex class body of ``runs`` in groups, each behind the range it lies in.

    The JVM tests a class range by range; behind groups of groups a character is held against
    a few dozen ranges at most, however many there are.
    """
    groups = [[run] for run in runs]
    bodies = [_body([run]) for run in runs]
    while len(groups) > width:
        some = range(0, len(groups), width)
        bodies = [f"[{_body([(groups[i][0][0], groups[min(i + width, len(groups)) - 1][-1][1])])}&&[{''.join(bodies[i : i + width])}]]" for i in some]
        groups = [[run for group in groups[i : i + width] for run in group] for i in some]
    return "".join(bodies)


@cache
def nonprintable() -> str:
    known = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Z}&&[^ \n\t\r]]"
    return rf"[{known}[\p{{Cn}}&&[^{_ranges(str.isprintable)}]]]"


@cache
def word_char() -> str:
    return rf"[\p{{L}}\p{{N}}_[\p{{Cn}}&&[{_ranges(str.isalnum)}]]]"


@cache
def digit_char() -> str:
    other = _ranges(lambda c: c.isdigit() and unicodedata.category(c) != "Nd")
    return rf"[\p{{Nd}}{other}[\p{{Cn}}&&[{_ranges(str.isdecimal)}]]]"


@cache
def may_change() -> str:
    """Characters of texts that NFKC or the removal of nonprintables may change.

    A text without any of them is normalized by the quick check of Unicode: no character
    changes alone, none joins one before it, and none is a mark that could be out of order.
    """
    seconds = {p[1] for p in (unicodedata.decomposition(chr(c)).split() for c in range(sys.maxunicode + 1)) if len(p) == 2 and p[0][0] != "<"}
    joining = {chr(int(p, 16)) for p in seconds} | {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}

    def wanted(c: str) -> bool:
        if not c.isprintable() and c not in "\n\t\r":
            return True
        return unicodedata.normalize("NFKC", c) != c or unicodedata.combining(c) > 0 or c in joining

    runs = _runs(lambda c: c > "\x7f" and wanted(c))
    return rf"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F[\x{{80}}-\x{{10ffff}}&&[{_nested(runs)}]]]"


SPACE_CHAR = r"[\p{Z}\t\n\x0B\f\r\x1c-\x1f\x85]"


def _nfkc_batch(texts: pa.Array) -> pa.Array:
    """The normalized text where it differs, else null."""
    normal, is_normal = unicodedata.normalize, unicodedata.is_normalized
    changed = [None if t is None or is_normal("NFKC", t) else normal("NFKC", t) for t in texts.to_pylist()]
    return pa.array(changed, pa.string())


def nfkc(text: Column) -> Column:
    """Unicode NFKC.  Spark has no such function, so texts that may change visit Python, which
    answers only where they do; all other rows send and get a null."""
    normalize = in_slices(_nfkc_batch, T.StringType())
    return F.coalesce(normalize(F.when(_unsettled(text), text)), text)


def _unsettled(text: Column) -> Column:
    """Whether a text beyond ASCII holds a character of ``may_change``."""
    return (F.octet_length(text) > F.length(text)) & text.rlike(may_change())


def drop_nonprintable(text: Column) -> Column:
    return F.regexp_replace(text, nonprintable(), "")


def _unicode_batch(texts: pa.Array) -> pa.Array:
    """NFKC without nonprintable characters where that differs from the text, else null."""
    normal, is_normal = unicodedata.normalize, unicodedata.is_normalized

    def change(text: str | None) -> str | None:
        if text is None:
            return None
        clean = text if is_normal("NFKC", text) else normal("NFKC", text)
        if not clean.replace("\n", "").replace("\t", "").replace("\r", "").isprintable():
            clean = "".join([c for c in clean if c.isprintable() or c in "\n\t\r"])
        return None if clean == text else clean

    return pa.array([change(t) for t in texts.to_pylist()], pa.string())


def printable_nfkc(text: Column) -> Column:
    """``drop_nonprintable(nfkc(text))``: texts that visit Python for NFKC lose their
    nonprintable characters there; of the others only ASCII texts can hold some, controls."""
    change = in_slices(_unicode_batch, T.StringType())
    plain = F.when(text.rlike(ASCII_CONTROLS), F.regexp_replace(text, ASCII_CONTROLS, "")).otherwise(text)
    beyond_ascii = F.octet_length(text) > F.length(text)
    return F.coalesce(change(F.when(_unsettled(text), text)), F.when(beyond_ascii, text).otherwise(plain))


def strip_html(text: Column) -> Column:
    return F.regexp_replace(text, HTML_TAG, " ")


def unlink_markdown(text: Column) -> Column:
    return F.regexp_replace(text, MARKDOWN_LINK, "$1")


def drop_markdown_symbols(text: Column) -> Column:
    return F.regexp_replace(text, MARKDOWN_SYMBOLS, " ")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, BLANK_RUN, " ")


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, NEWLINE_RUN, "\n\n")


def strip_ends(text: Column) -> Column:
    return F.trim(text, F.lit(STRIPPED))


def _where_held(text: Column, needed: str, change: Callable[[Column], Column]) -> Column:
    return let(text, lambda t: F.when(F.contains(t, F.lit(needed)), change(t)).otherwise(t))


def clean_text(text: Column, lowercase: bool = False) -> Column:
    """The whole cleaning chain; null gives the empty string."""
    # A pattern is only tried where the characters it needs stand; looking for those is cheap.
    cleaned = _where_held(printable_nfkc(text), "<", strip_html)
    cleaned = _where_held(cleaned, "](", unlink_markdown)
    cleaned = F.regexp_replace(cleaned, SYMBOL_OR_BLANK_RUN, " ")
    cleaned = strip_ends(_where_held(cleaned, "\n\n\n", collapse_newlines))
    if lowercase:
        cleaned = F.lower(cleaned)
    return F.coalesce(cleaned, F.lit(""))


def nonblank(text: Column) -> Column:
    """Not null and more than spaces (only spaces count as blank here)."""
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


def split_word_count(text: Column) -> Column:
    """Parts between runs of white space; the empty string has one part."""
    return F.size(F.split(text, r"\s+"))


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{word_char()}+"), F.lit(0))


def lexical_stats(text: Column) -> dict[str, Column]:
    return {
        "char_count": F.length(text),
        "word_count": F.regexp_count(text, F.lit(f"{word_char()}+")),
        "digit_count": F.regexp_count(text, F.lit(digit_char())),
        "whitespace_count": F.regexp_count(text, F.lit(SPACE_CHAR)),
    }
