"""Text standardisation as native Spark column expressions.

No Python UDFs: every function returns a ``Column`` built from regular
expressions and higher-order array functions, evaluated in the JVM.
The regular expressions avoid look-behind so that the same patterns also run
in RE2-based engines (used by the SQL oracle in the tests).
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.common import as_col

# --- fixed values -------------------------------------------------------
# The characters Python's ``str.isspace`` treats as white space (and so
# ``str.strip`` / ``str.split`` use): tab, line feed, vertical tab, form feed,
# carriage return, the four information separators U+001C..U+001F, space,
# next line U+0085, no-break space U+00A0, ogham space U+1680, the spaces
# U+2000..U+200A, line and paragraph separators U+2028, U+2029, narrow
# no-break space U+202F, medium mathematical space U+205F, ideographic space
# U+3000.
WS_CLASS = (r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}"
            r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
NON_WS_CLASS = "[^" + WS_CLASS[1:]
# Letters that have case (upper, lower, title): the ones ``str.title`` acts on.
CASED_CLASS = r"[\p{Lu}\p{Ll}\p{Lt}]"
UNCASED_CLASS = r"[^\p{Lu}\p{Ll}\p{Lt}]"
# Named character references: the HTML 4 set from the standard library
# (``html.entities.name2codepoint``) plus ``apos``.
ENTITY_CODEPOINTS = dict(html.entities.name2codepoint, apos=39)
# Numeric references 128-159 mean the characters of Windows-1252 at these places
# (five of them have none and stay control characters).
CP1252_CHARS = {n: ch for n in range(128, 160) if (ch := bytes([n]).decode("cp1252", "ignore"))}
# -------------------------------------------------------------------------

STRIP_RE = r"\A" + WS_CLASS + r"+|" + WS_CLASS + r"+\z"
WORD_RE = NON_WS_CLASS + "+"
CASE_RUN_RE = CASED_CLASS + "+|" + UNCASED_CLASS + "+"

# One token of an HTML document: a comment, a script or style element with
# its content, a CDATA section, any other tag, or a run of text.
# Script and style elements without an end reach to the end of the text; a
# quoted attribute value may hold ">" (an unbalanced quote: up to the next ">").
HTML_TOKEN_RE = (r"(?is)<!--.*?-->|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
                 r"|<!\[CDATA\[.*?\]\]>|<[^>\x22']*(?:\x22[^\x22]*\x22[^>\x22']*|'[^']*'[^>\x22']*)*>|<[^>]*>|[^<]+")
# A '<' that cannot open a tag is text; it is parked as U+0002 while tokenising.
LONE_LT_RE = r"<([^A-Za-z/!?]|\z)"
LT_MARK = "\u0002"


def strip(c) -> Column:
    """``str.strip()``: removes leading/trailing Unicode white space.

    Spark's ``trim`` removes only blanks; tabs, line breaks and no-break
    spaces are stripped here as well.
    """
    return F.regexp_replace(as_col(c), STRIP_RE, "")


def upper_strip(c) -> Column:
    return strip(F.upper(as_col(c)))


def lower_strip(c) -> Column:
    return strip(F.lower(as_col(c)))


def title_case(c) -> Column:
    """``str.title()``: first cased letter of every cased run upper, rest lower.

    ``"usb-c"`` -> ``"Usb-C"``, ``"men's"`` -> ``"Men'S"`` (``initcap`` only
    starts words after blanks).
    """
    runs = F.regexp_extract_all(F.lower(as_col(c)), F.lit(CASE_RUN_RE), 0)
    titled = F.transform(
        runs,
        lambda r: F.when(r.rlike("^" + CASED_CLASS),
                         F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30)))
        .otherwise(r),
    )
    return F.when(as_col(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(titled, ""))


def strip_title(c) -> Column:
    return title_case(strip(c))


def words(c) -> Column:
    """``x.split()`` as an array of strings (empty array for null).

    A split at white-space runs gives an empty first/last element when the
    text starts/ends with white space; those are dropped.
    """
    parts = F.split(F.coalesce(as_col(c), F.lit("")), WS_CLASS + "+", -1)
    return F.filter(parts, lambda w: w != "")


def word_count(c) -> Column:
    """``len(x.split())``; null text counts 0 words."""
    return F.size(words(c)).cast("long")


def text_length(c) -> Column:
    """Length in code points; null counts 0."""
    return F.coalesce(F.length(as_col(c)).cast("long"), F.lit(0).cast("long"))


def _literal_map(entries) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries for x in pair])


def _codepoint_char(n: Column) -> Column:
    """Character of a code point; 128-159 as in Windows-1252; invalid ones (0,
    surrogates, > U+10FFFF) -> U+FFFD."""
    valid = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    ch = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    western = F.when(n.between(128, 159), F.try_element_at(_literal_map(CP1252_CHARS.items()), n))
    return F.when(valid, F.coalesce(western, ch)).otherwise(F.lit("�"))


def unescape(c) -> Column:
    """Decode character references in one pass (no double decoding).

    The text is split at ``&``; each piece after the first starts with a
    reference (``name``, ``#123``, ``#x1F``) or is a literal ``&``. The ``;``
    after a reference may be missing: then a name ends before the first
    character that is no letter, digit, ``-`` or ``.``, and a number before the
    first that is no hexadecimal digit (``&copy 2020`` -> ``© 2020``; ``&copy2020``
    stays as it is).
    """
    entities = _literal_map((name, chr(cp)) for name, cp in sorted(ENTITY_CODEPOINTS.items()))

    def piece(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]*)(?:[^A-Za-z0-9.-]|\z)", 1)
        dec = F.regexp_extract(p, r"^#0*([0-9]{1,7})(?:[^0-9A-Fa-f]|\z)", 1)
        hexa = F.regexp_extract(p, r"^#[xX]0*([0-9A-Fa-f]{1,6})(?:[^0-9A-Fa-f]|\z)", 1)
        rest = F.regexp_replace(p, r"\A#[xX]?[0-9A-Fa-f]+;?", "")
        named = F.try_element_at(entities, name)
        return (
            F.when(i == 0, p)
            .when(named.isNotNull(), F.concat(named, F.regexp_replace(p, r"\A[A-Za-z0-9]+;?", "")))
            .when(dec != "", F.concat(_codepoint_char(dec.cast("int")), rest))
            .when(hexa != "", F.concat(_codepoint_char(F.conv(hexa, 16, 10).cast("int")), rest))
            .otherwise(F.concat(F.lit("&"), p))
        )

    c = as_col(c)
    return F.when(F.instr(c, "&") == 0, c).otherwise(
        F.array_join(F.transform(F.split(c, "&", -1), piece), ""))


def html_to_text(c) -> Column:
    """HTML -> plain text, like a parser's text nodes joined by one blank.

    Text nodes are kept in document order, each stripped, empty ones dropped;
    comments, doctype/processing instructions, ``<script>`` and ``<style>``
    content are dropped; character references are decoded; CDATA sections are
    text (not decoded, tags inside them kept). Null or empty input gives ``''``.
    The control character U+0002 (not allowed in HTML) is dropped.
    """
    src = F.regexp_replace(F.replace(F.coalesce(as_col(c), F.lit("")), F.lit(LT_MARK), F.lit("")), LONE_LT_RE, LT_MARK + "$1")
    tokens = F.regexp_extract_all(src, F.lit(HTML_TOKEN_RE), 0)

    def node_text(t: Column) -> Column:
        upper_head = F.upper(F.substring(t, 1, 9))
        cdata = F.substring(t, 10, F.length(t) - 12)
        text = (
            F.when(upper_head == "<![CDATA[", F.replace(cdata, F.lit(LT_MARK), F.lit("<")))
            .when(F.startswith(t, F.lit("<")), F.lit(""))
            .otherwise(unescape(F.replace(t, F.lit(LT_MARK), F.lit("<"))))
        )
        return strip(text)

    texts = F.filter(F.transform(tokens, node_text), lambda s: s != "")
    return F.array_join(texts, " ")
