"""Column-level text normalisation and checks (built-in expressions only).

Every function takes and returns a ``Column`` so it stays inside whole-stage
codegen.  Java regex rules apply: ``\\w``/``\\s`` are ASCII unless ``(?U)``;
``(?d)`` makes ``.`` stop at ``\\n`` only, like Python's ``re``.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -------------------------
# Characters replaced by a space in "clean A" (the entity alternatives of the
# original pattern never fire because '&' matches first).
CLEAN_A_CHARS = "-&;'\"<>"
# Characters stripped from the right, in this order, by "clean B".
CLEAN_B_RSTRIP = ["。", ".", "?", "？"]
# Punctuation allowed by the romaji check next to ASCII letters and digits.
ROMAJI_PUNCT = "!@#$%^&*()_+{}[]:;\"'<>,.?/\\|-~`"
# Display template of a question (labels and separators as in the source data).
DISPLAY_GENERAL = "_____GENERAL____: \n"
DISPLAY_AUDIO = " \n_____GENERAL_AUDIO_TEXT____: \n"
DISPLAY_CONTENT = " \n_____CONTENT____: \n"
# --------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace on both ends."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def alnum_lower(c) -> Column:
    """Keep Unicode letters and digits only, lower-cased."""
    return F.lower(F.regexp_replace(_c(c), r"[^\p{L}\p{N}]", ""))


def ascii_alnum_lower(c) -> Column:
    """P3 restricted to ASCII (oracle-comparable fixture form)."""
    return F.lower(F.regexp_replace(_c(c), "[^a-zA-Z0-9]", ""))


def clean_a(c) -> Column:
    """Special characters to space, lower-case, collapse whitespace."""
    spaced = F.regexp_replace(_c(c), "[-&;'\"<>]", " ")
    return py_strip(F.regexp_replace(F.lower(spaced), r"(?U)\s+", " "))


def clean_a_array(c) -> Column:
    """Clean A on every element of an array."""
    return F.transform(_c(c), clean_a)


def clean_b(c) -> Column:
    """Strip, strip commas, right-strip the four end marks, upper, drop ',' and ' '."""
    t = F.regexp_replace(py_strip(c), r"^,+|,+$", "")
    for ch in CLEAN_B_RSTRIP:
        t = F.regexp_replace(t, "(?:" + _re_escape(ch) + ")+$", "")
    t = F.upper(t)
    return F.replace(F.replace(t, F.lit(","), F.lit("")), F.lit(" "), F.lit(""))


def _re_escape(ch: str) -> str:
    return "\\" + ch if ch in ".?*+()[]{}|^$\\" else ch


def remove_special(c) -> Column:
    """P10: drop characters that are neither word nor space, then drop spaces."""
    return F.replace(F.regexp_replace(_c(c), r"(?U)[^\w\s]", ""), F.lit(" "), F.lit(""))


def strip_tag_attributes(c) -> Column:
    """``<tag attr...>`` -> ``<tag>``."""
    return F.regexp_replace(_c(c), r"(?U)<(\w+)(\s+[^>]+)?>", "<$1>")


def html_to_lines(c) -> Column:
    """``<div>x</div>`` -> ``x\\n``; every other tag -> ``\\n``."""
    t = F.regexp_replace(_c(c), r"(?d)<div>(.*?)</div>", "$1\n")
    return F.regexp_replace(t, r"<[^>]+>", "\n")


def compact_question(general, content) -> Column:
    """G_text + G_text_audio + each Q_text and its A_text, no separators."""
    g = _c(general)
    items = F.transform(_c(content), lambda x: F.concat(
        F.coalesce(x["Q_text"], F.lit("")),
        F.array_join(F.coalesce(x["A_text"], F.array()), "")))
    return F.concat(F.array_join(F.coalesce(g["G_text"], F.array()), ""),
                    F.coalesce(g["G_text_audio"], F.lit("")),
                    F.array_join(F.coalesce(items, F.array()), ""))


def display_question(general, content, sep: str = "\n") -> Column:
    """The review text of a question (numbered questions and answers)."""
    g = _c(general)
    parts = F.transform(_c(content), lambda x, i: F.concat(
        F.lit("Question "), (i + 1).cast("string"), F.lit(": "), F.coalesce(x["Q_text"], F.lit("")),
        F.lit(sep), F.lit("Answer "), (i + 1).cast("string"), F.lit(": "),
        F.array_join(F.coalesce(x["A_text"], F.array()), sep)))
    return F.concat(F.lit(DISPLAY_GENERAL), F.array_join(F.coalesce(g["G_text"], F.array()), sep),
                    F.lit(DISPLAY_AUDIO), F.coalesce(g["G_text_audio"], F.lit("")),
                    F.lit(DISPLAY_CONTENT), F.array_join(F.coalesce(parts, F.array()), sep))


# --- T*: row checks --------------------------------------------------------

def is_japanese(c) -> Column:
    """Whole-string range compare (in effect the first character decides)."""
    w = _c(c)
    return (w.between("一", "鿿") | w.between("぀", "ヿ")) & (w != "")


def is_vietnamese(c) -> Column:
    """T2."""
    return ~is_japanese(c)


def is_han(c) -> Column:
    """Every character in U+4E00..U+9FFF ('' is True)."""
    return ~_c(c).rlike("[^一-鿿]")


def is_latin(c) -> Column:
    """T4."""
    return _c(c).rlike("^[a-zA-Z]+$")


def contains_latin_or_numbers(c) -> Column:
    """T5."""
    return _c(c).rlike("[a-zA-Z0-9]+")


def count_han(c) -> Column:
    """T6."""
    return F.regexp_count(_c(c), F.lit("[一-鿿]"))


def count_paren_pairs(c) -> Column:
    """Occurrences of ``()``."""
    return F.regexp_count(_c(c), F.lit(r"\(\)"))


def contains_html(c) -> Column:
    """``<.*?>`` somewhere (``.`` not crossing a newline)."""
    return _c(c).rlike(r"(?d)<.*?>")


def is_number(c) -> Column:
    """Parses as a Python float (underscores between digits, Unicode digits,
    exponent, inf/infinity/nan; surrounding whitespace ignored)."""
    d = r"\d(?:_?\d)*"
    pat = (r"(?iU)^[+-]?(?:(?:" + d + r"(?:\.(?:" + d + r")?)?|\." + d + r")(?:e[+-]?" + d + r")?"
           r"|inf|infinity|nan)$")
    return py_strip(c).rlike(pat)


def count_p_close(c) -> Column:
    """Literal ``</p>`` count when the text holds HTML, else 0."""
    return F.when(contains_html(c), F.regexp_count(_c(c), F.lit("</p>"))).otherwise(F.lit(0))


def p_tags_balanced_regex(c) -> Column:
    """T10 fast form: opening ``<p>`` count equals literal ``</p>`` count (True without HTML)."""
    opens = F.regexp_count(_c(c), F.lit(r"(?i)<p(\s[^>]*)?/?>"))
    return F.when(contains_html(c), opens == F.regexp_count(_c(c), F.lit("</p>"))).otherwise(F.lit(True))


def matches(c, pattern: str) -> Column:
    """Any match of a caller-supplied regex."""
    return _c(c).rlike(pattern)


def contains_kana(c) -> Column:
    """T13."""
    return _c(c).rlike("[぀-ゟ゠-ヿー]")


def contains_romaji(c) -> Column:
    """Only ASCII letters, digits, listed punctuation and whitespace."""
    punct = "".join("\\" + ch if ch in "[]\\^-" else ch for ch in ROMAJI_PUNCT)
    return _c(c).rlike(r"(?U)^[a-zA-Z0-9\s" + punct + "]+$")


def _nonblank_lines(c) -> Column:
    return F.filter(F.transform(F.split(_c(c), "\n"), py_strip), lambda s: s != "")


def answer_check_index(col1, col2, col3, pattern: str, group: int = 0) -> Column:
    """First regex match of col1, cut before the 'na' marker, equals the
    col3-th non-blank line of col2 (Python indexing of ``int(col3)-1``, so 0 is
    the last line) after clean B.  Out-of-range or unparsable index -> False."""
    found = F.regexp_extract_all(F.coalesce(_c(col1), F.lit("")), F.lit(pattern), F.lit(group))
    m0 = F.element_at(found, 1)
    cut1 = F.when(m0.contains("[な]"), F.element_at(F.split(m0, r"\[な\]"), 1)).otherwise(
        F.element_at(F.split(m0, r"\[な"), 1))
    cut = F.when(cut1.contains("["), F.element_at(F.split(m0, r"\[na\]"), 1)).otherwise(cut1)
    n = py_strip(_c(col3).cast("string")).try_cast("int")
    picked = F.try_element_at(_nonblank_lines(col2), F.when(n >= 1, n).otherwise(n - 1))
    c2_empty = F.coalesce(_c(col2), F.lit("")) == ""
    no_match = F.size(found) == 0
    return (F.when(c2_empty & no_match, F.lit(True))
            .when(c2_empty | no_match, F.lit(False))
            .otherwise(F.coalesce(clean_b(picked) == clean_b(cut), F.lit(False))))


def answer_check_text(col1, col2, pattern: str, group: int = 0) -> Column:
    """Clean B of (P10 of the first match) equals clean B of (P10 of col2)."""
    found = F.regexp_extract_all(F.coalesce(_c(col1), F.lit("")), F.lit(pattern), F.lit(group))
    c2_empty = F.coalesce(_c(col2), F.lit("")) == ""
    no_match = F.size(found) == 0
    return (F.when(c2_empty & no_match, F.lit(True))
            .when(c2_empty | no_match, F.lit(False))
            .otherwise(clean_b(remove_special(F.element_at(found, 1))) == clean_b(remove_special(col2))))


# --- P13, P14, T10: text of HTML ---------------------------------------------------
# Rule: script and style elements, comments and the doctype give their content as
# text; every other tag (``<`` and a letter, ``/``, ``!`` or ``?`` up to ``>``) is
# cut out; then character references are decoded once.

HTML_TOKEN = (r"(?is)<script\b[^>]*>(.*?)</script>|<style\b[^>]*>(.*?)</style>|<!--(.*?)-->"
              r"|<!doctype\s+([^>]*)>|<[a-z/!?][^>]*>")
# References as HTML defines them: ``&#233;`` and ``&#xE9;`` (the ``;`` may be missing), a
# name of the standard's table with ``;``, else the longest name that the standard also
# knows without one; anything else stays.  The table is Python's, by parameter.
NAMED_REFERENCES = html.entities.html5
#: Code points that the standard reads as windows-1252, its free places as they are.
CP1252 = {n: bytes([n]).decode("cp1252", errors="ignore") or chr(n) for n in range(0x80, 0xA0)}


def _code_point(n: Column) -> Column:
    """Text of a code point as a numeric reference gives it."""
    low = n.bitwiseAND(F.lit(0xFFFF))
    gone = (n.between(1, 8) | (n == 0x0B) | n.between(0x0E, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE))
    old = F.create_map(*[F.lit(x) for kv in CP1252.items() for x in kv])
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("�"))
            .when(n.between(0x80, 0x9F), F.element_at(old, n.cast("int"))).when(gone, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def _reference(part: Column, names: dict[str, str]) -> Column:
    """``part`` starts with ``&``: the reference there replaced, the rest kept."""
    def table(entries):
        # one constant that is folded into a literal map
        return F.map_from_arrays(*[F.split(F.lit("\x01".join(x)), "\x01") for x in zip(*entries)])

    whole = table(sorted(((k, v) for k, v in names.items() if k.endswith(";")), key=lambda kv: (len(kv[0]), kv[0])))
    bare = {k: v for k, v in names.items() if not k.endswith(";")}
    prefix = table(bare.items())
    longest = "|".join(sorted(bare, key=lambda k: (-len(k), k)))

    def number(digits, base):
        # longer than any code point: beyond the last one
        value = F.ltrim(digits, F.lit("0"))
        n = F.when(F.length(value) > 8, F.lit(1 << 40)).otherwise(F.coalesce(F.conv(digits, base, 10).cast("long"), F.lit(0).cast("long")))
        return _code_point(n)

    def cut(length):
        return F.substr(part, length + 1)

    dec = F.regexp_extract(part, r"^&#([0-9]+);?", 1)
    hexa = F.regexp_extract(part, r"^&#[xX]([0-9a-fA-F]+);?", 1)
    name = F.regexp_extract(part, r"^&([A-Za-z][A-Za-z0-9]*;)", 1)
    start = F.regexp_extract(part, f"^&({longest})", 1)
    numeric = F.length(F.regexp_extract(part, r"^&#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0))
    return (F.when(dec != "", F.concat(number(dec, 10), cut(numeric)))
            .when(hexa != "", F.concat(number(hexa, 16), cut(numeric)))
            .when(F.map_contains_key(whole, name), F.concat(F.element_at(whole, name), cut(F.length(name) + 1)))
            .when(start != "", F.concat(F.element_at(prefix, start), cut(F.length(start) + 1)))
            .otherwise(part))


def decode_entities(c, names: dict[str, str] = NAMED_REFERENCES) -> Column:
    """Character references decoded once.  A text is cut before every ``&``; each piece
    has at most one reference, at its start."""
    pieces = F.transform(F.split(_c(c), "(?=&)"), lambda p: F.when(p.startswith("&"), _reference(p, names)).otherwise(p))
    return F.when(F.contains(_c(c), F.lit("&")), F.array_join(pieces, "")).otherwise(_c(c))


def text_of_html(c) -> Column:
    """All text nodes joined; a text without a tag stays as it is."""
    return F.when(contains_html(c), decode_entities(F.regexp_replace(_c(c), HTML_TOKEN, "$1$2$3$4"))).otherwise(_c(c))


def latin_text_of_html(c) -> Column:
    """Stripped text nodes that hold a Latin letter or a digit, joined; a
    leading ``()`` before the first tag stays."""
    nodes = F.split(F.regexp_replace(_c(c), HTML_TOKEN, "\x01$1$2$3$4\x01"), "\x01")
    kept = F.filter(F.transform(nodes, lambda n: py_strip(decode_entities(n))), lambda n: n.rlike("[a-zA-Z0-9]"))
    lead = F.when(_c(c).startswith("()<"), F.lit("()")).otherwise(F.lit(""))
    return F.when(contains_html(c), F.concat(lead, F.array_join(kept, ""))).otherwise(_c(c))


def p_tags_balanced(c) -> Column:
    """As many ``<p>`` elements opened (outside scripts, styles and comments)
    as there are ``</p>`` in the raw text."""
    shown = F.regexp_replace(_c(c), r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->", "")
    opened = F.regexp_count(shown, F.lit(r"(?i)<p[\s/>]"))
    closed = F.regexp_count(_c(c), F.lit("</p>"))
    return F.when(contains_html(c), opened == closed).otherwise(F.lit(True))
