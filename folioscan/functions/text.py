"""Text functions as Column expressions: HTML to text, folding, links, verdicts, locators, sort keys.

Python is used only where Spark has no expression: entity decoding, NFKC and
the elision rule; those are Arrow UDFs. Everything else stays in the JVM.
"""

from __future__ import annotations

import bisect
import html
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Typographic characters and their plain forms.
PLAIN = {
    "'": "‘’‚‛",
    '"': "“”„‟",
    "-": "‐‑‒–—―−",
    " ": "\u00a0\u2007\u202f\u2009",
    "...": "…",
}
_TABLE = {ord(c): to for to, chars in PLAIN.items() for c in chars}
#: What an elided gap may hold, its greatest length, and the least lengths of the parts around it.
GAP, GAP_MOST, HEAD_LEAST, TAIL_LEAST = r"(?:\s|[\"'`]|\[\d+[a-z]?\]|[.,;:]|-)*?", 40, 40, 20
#: Characters that may be trimmed from a quotation's ends.
EDGES = " \"'-.,;:"
#: Elements whose start tag begins a new line, and elements without visible text.
BLOCK, HIDDEN = ("br", "p", "div", "li"), ("script", "style")
#: A character reference that is closed; HTML 5 also decodes old names that aren't ("&amp" as "&").
REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8, "IX": 9, "X": 10, "XI": 11, "XII": 12}


def fold_text(text: str) -> str:
    """The folded form of a string: entities, NFKC, lower case, plain punctuation, single spaces, tight dashes."""
    plain = unicodedata.normalize("NFKC", html.unescape(text)).lower().translate(_TABLE)
    return re.sub(" ?- ?", "-", " ".join(plain.split())).strip()


def elided(needle: str, hay: str) -> bool:
    """Whether a folded needle is in the folded hay but for one short gap without prose."""
    n = bisect.bisect_left(range(1, len(needle) + 1), True, key=lambda k: needle[:k] not in hay)
    head, tail = needle[:n].strip(), needle[n:].strip()
    if len(head) < HEAD_LEAST or len(tail) < TAIL_LEAST:
        return False
    pattern = re.compile(f"(?=({re.escape(head)})({GAP}){re.escape(tail)})")
    return any(len(m[2]) <= GAP_MOST for m in pattern.finditer(hay))


def _decode(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", html.unescape(t)))


def _unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


def _unescape_closed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else re.sub(REFERENCE, lambda m: html.unescape(m[0]), t))


def _elided(needle: pd.Series, hay: pd.Series) -> pd.Series:
    return pd.Series([None if n is None or h is None else elided(n, h) for n, h in zip(needle, hay, strict=True)], dtype="object")


def unescape(text: Column, closed: bool = False) -> Column:
    """HTML entities decoded once; with `closed` only those that end in a semicolon."""
    return F.pandas_udf(_unescape_closed if closed else _unescape, "string")(text)


def elided_udf(needle: Column, hay: Column) -> Column:
    """elided() on columns of folded texts; null if either is null."""
    return F.pandas_udf(_elided, "boolean")(needle, hay)


def plain_fold(text: Column) -> Column:
    """The native part of folding, for text whose entities are decoded and which is in NFKC."""
    out = F.lower(text)
    for to, chars in PLAIN.items():
        out = F.replace(out, F.lit(chars), F.lit(to)) if len(chars) == 1 else F.translate(out, chars, to * len(chars))
    out = F.regexp_replace(out, r"(?U)[\s\x1C-\x1F]+", " ")
    return F.trim(F.regexp_replace(out, r" ?- ?", "-"))


def fold(text: Column) -> Column:
    """fold_text() on a column; null stays null."""
    return plain_fold(F.pandas_udf(_decode, "string")(text))


def trim_quotes(text: Column) -> Column:
    """Quotes, dashes and stops off both ends."""
    return F.btrim(text, F.lit(EDGES))


def grounded(needle: Column, hay: Column, strict: bool = True) -> Column:
    """Folded needle in folded hay, as it is or trimmed.

    strict=False lets a needle of edge punctuation alone pass, as an empty
    string is part of any other.
    """
    trimmed = trim_quotes(needle)
    full = trimmed != "" if strict else F.lit(True)
    return (needle != "") & (hay.contains(needle) | (full & hay.contains(trimmed)))


def html_text(page: Column, closed: bool = False) -> Column:
    """Visible text of HTML by native patterns: hidden elements, comments and tags go, block starts break lines.

    Entities are decoded twice by an Arrow UDF, as decoding stands before and
    after the parser's; blanks are collapsed, blank lines squeezed, ends
    stripped. closed: see unescape().
    """
    out = reduce(lambda c, tag: F.regexp_replace(c, rf"(?is)<{tag}\b[^>]*>.*?(</{tag}\s*>|\z)", ""), HIDDEN, page)
    out = F.regexp_replace(out, r"(?s)<!--.*?-->|<![^>]*>|<\?[^>]*>", "")
    out = F.regexp_replace(out, rf"(?i)<({'|'.join(BLOCK)})(\s[^>]*|/)?>", "\n")
    out = unescape(unescape(F.regexp_replace(out, r"</?[A-Za-z][^>]*>", ""), closed), closed)
    return tidy(out)


def tidy(text: Column) -> Column:
    """Runs of blanks as one space, runs of blank lines as one, no white space at the ends."""
    out = F.regexp_replace(text, r"[ \t]+", " ")
    out = F.regexp_replace(out, r"\n\s*\n+", "\n\n")
    return F.regexp_replace(out, r"(?U)\A\s+|\s+\z", "")


def markdown_text(text: Column) -> Column:
    """Line ends as \\n; nothing else changes."""
    return F.regexp_replace(text, "\r\n?", "\n")


def visible(text: Column) -> Column:
    """Tags as spaces, white space collapsed, lower case: the comparison form of aligned witnesses."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", " "), r"(?U)[\s\x1C-\x1F]+", " ")))


def without_markers(text: Column) -> Column:
    """Generated chapter, section, asset and formula markers removed."""
    return F.regexp_replace(text, r"<!--@@[^>]*-->", "")


def squeezed(text: Column) -> Column:
    """White space collapsed and stripped."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1C-\x1F]+", " "))


def unspaced(text: Column) -> Column:
    """No white space at all."""
    return F.regexp_replace(text, r"(?U)[\s\x1C-\x1F]+", "")


def wikilinks(text: Column) -> Column:
    """The inside of every [[...]], in order."""
    return F.regexp_extract_all(text, F.lit(r"\[\[([^\]]+)\]\]"), F.lit(1))


def link_target(raw: Column) -> Column:
    """What a wikilink points to: before | and #, trimmed."""
    return F.trim(F.split_part(F.split_part(raw, F.lit("|"), F.lit(1)), F.lit("#"), F.lit(1)))


def unsafe_path(path: Column) -> Column:
    """Empty, absolute, with a backslash or with a part that goes up."""
    return (path == "") | path.startswith("/") | path.contains("\\") | F.array_contains(F.split(path, "/"), "..")


def markdown_links(text: Column) -> Column:
    """Targets of [..](..) and ![..](..), angle brackets off."""
    targets = F.regexp_extract_all(text, F.lit(r"!?\[[^\]]*\]\((<[^>]+>|[^\s)]+)"), F.lit(1))
    return F.transform(targets, lambda t: F.btrim(t, F.lit("<>")))


def labels(text: Column) -> Column:
    """Bracketed labels in upper case, without repeats, in first order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\[([^\]]+)\]"), F.lit(1)), lambda x: F.upper(x)))


def fence_length(text: Column) -> Column:
    """One more than the longest run of backticks, three at least."""
    runs = F.transform(F.regexp_extract_all(text, F.lit("(`+)"), F.lit(1)), lambda x: F.length(x))
    return F.greatest(F.lit(3), F.coalesce(F.array_max(runs), F.lit(0)) + 1)


def safe_id(name: Column) -> Column:
    return F.coalesce(name.rlike(r"\A[A-Za-z0-9][A-Za-z0-9_-]{0,127}\z"), F.lit(False))


#: A verdict line, what separates its reason, and the wording that counts as a verdict without one.
VERDICT_LINE, VERDICT_MARKS = r"(?im)^\s*VERDICT:\s*(PASS|FAIL)\b[ \t]*(.*)$", "-–—:"
POSITIVE, NEGATIVE = ("verified sound", "verified clean"), r"\bfail(ed|ure)?\b|blocking defect|\bdefects?\b|not verified|unable to verify"


def verdict(reply: Column) -> Column:
    """struct(verdict, detail) of a verifier's reply: its last verdict line, else an unambiguous statement.

    A FAIL without a reason is no verdict.
    """
    text = F.coalesce(reply, F.lit(""))
    line = F.lit(VERDICT_LINE)
    word = F.upper(F.element_at(F.regexp_extract_all(text, line, F.lit(1)), -1))
    rest = F.element_at(F.regexp_extract_all(text, line, F.lit(2)), -1)
    detail = squeeze_ends(F.ltrim(squeeze_ends(rest), F.lit(VERDICT_MARKS)))
    low = F.lower(text)
    sound = (low.contains(POSITIVE[0]) | low.contains(POSITIVE[1])) & ~low.rlike(NEGATIVE)
    found = F.regexp_count(text, line) > 0
    none = F.lit(None).cast("string")
    name = F.when(found & (word == "FAIL") & (detail == ""), none).when(found, word).when(sound, "PASS").otherwise(none)
    why = F.when(found & (word == "FAIL") & (detail == ""), "FAIL with no enumerated defect").when(found, detail).when(sound, "implicit positive attestation").otherwise("no usable VERDICT line or unambiguous positive attestation")
    return F.struct(name.alias("verdict"), why.alias("detail"))


def squeeze_ends(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def canonical_book(locator: Column, work: str = "Aen") -> Column:
    """The book of a canonical locator such as Aen.1.5; null if it isn't one."""
    return F.nullif(F.regexp_extract(locator, rf"\A{work}\.\s*(\d+)\.", 1), F.lit("")).cast("int")


def witness_book(locator: Column) -> Column:
    """The book of a witness locator: a leading number with a separator, or BOOK and a Roman numeral to twelve."""
    number = F.nullif(F.regexp_extract(locator, r"\A\s*(\d{1,2})\s*[.;:-]", 1), F.lit("")).cast("int")
    roman = F.upper(F.regexp_extract(locator, r"(?i)\A\s*BOOK\s+([IVX]+)", 1))
    return F.coalesce(number, F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv])[roman])


def natural_key(name: Column, width: int = 20) -> Column:
    """A string that sorts digit runs by value: each is padded with zeros to a fixed width."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"\A\d"), F.lpad(F.ltrim(p, F.lit("0")), width, "0")).otherwise(p)), "")


def display_name(stem: Column) -> Column:
    """A page's title from its file stem; numbered books by their number."""
    book = F.regexp_extract(stem, r"book[- ]?(\d+)$", 1)
    return F.when(book != "", F.concat(F.lit("Book "), book.try_cast("bigint").cast("string"))).otherwise(F.initcap(F.replace(stem, F.lit("-"), F.lit(" "))))


def slug(name: Column) -> Column:
    """Lower case with runs of other characters as single dashes."""
    return F.btrim(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), F.lit("-"))


def lines(text: Column) -> Column:
    """Lines with their terminators, after line ends were unified."""
    return F.regexp_extract_all(text, F.lit(r"([^\n]*\n|[^\n]+\z)"), F.lit(1))
