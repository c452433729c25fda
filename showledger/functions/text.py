"""Text clean-up."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\s\p{Z}]+"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    return F.trim(F.coalesce(col(c), F.lit(""))) == ""


def none_if_blank(c) -> Column:
    """Trimmed text, or NULL when nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def first_present(*cols) -> Column:
    """First non-blank value, trimmed; '' when there is none."""
    return F.coalesce(*[none_if_blank(c) for c in cols], F.lit(""))


def normalize_space(c) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACES, " "))


def slugify(c) -> Column:
    lowered = F.replace(F.lower(F.trim(F.coalesce(col(c), F.lit("")))), F.lit("&"), F.lit("and"))
    return F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", "-"), F.lit("-"))


def contains_any(c, words: list[str]) -> Column:
    """True when the lower-cased text contains one of `words` (one regex pass)."""
    pattern = "|".join(re.escape(w) for w in words)
    return F.coalesce(F.lower(col(c)).rlike(pattern), F.lit(False))


def truncate_excerpt(c, limit: int) -> Column:
    """Cut at the last space beyond the midpoint of the first `limit` characters."""
    text = normalize_space(c)
    head = F.trim(F.left(text, F.lit(limit)))
    last_space = F.length(head) - F.instr(F.reverse(head), " ")
    cut = F.when(
        (F.instr(head, " ") > 0) & (last_space > F.floor(F.length(head) / 2)), F.left(head, last_space)
    ).otherwise(head)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(cut, F.lit("...")))


@functools.cache
def _names() -> tuple[str, str, str]:
    """JSON of name -> text, JSON of the names that need no semicolon, and their pattern, from the standard library's HTML5 table."""
    whole = {n[:-1]: v for n, v in entities.html5.items() if n.endswith(";")}
    short = {n: v for n, v in entities.html5.items() if not n.endswith(";")}
    return _celled(whole), _celled(short), "|".join(sorted(short, key=len, reverse=True))


#: Lengths of names that are told apart in the cells of a table; longer ones share the last.
_LENGTHS = 10


def _celled(names: dict[str, str]) -> str:
    """JSON of a table as an array of small maps, by first letter and length: Spark searches a map from its start."""
    cells = [{} for _ in range((ord("z") - ord("A") + 1) * _LENGTHS)]
    for name, text in names.items():
        cells[(ord(name[0]) - ord("A")) * _LENGTHS + min(len(name), _LENGTHS) - 1][name] = text
    return json.dumps(cells)


def _named(cells: Column, name: Column) -> Column:
    """Text of a name (letters and digits), NULL where it is none."""
    cell = (F.ascii(name) - ord("A")) * _LENGTHS + F.least(F.length(name), F.lit(_LENGTHS)) - 1
    return F.element_at(F.get(cells, F.when(name != "", cell)), name)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _code_point(n: Column) -> Column:
    """Text of a numeric reference: 128-159 are read as Windows-1252, what is no character becomes U+FFFD."""
    windows = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160))
    bad = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(n)), 8, "0")), "UTF-32")
    return F.when(n.between(128, 159), F.substring(F.lit(windows), (n - 127).cast("int"), F.lit(1))).otherwise(char)


#: A character reference; without the semicolon, the beginning of one.
_ENDED, _BEGUN = r"(?=&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);)", "(?=&(?:#[0-9xX]|[A-Za-z]))"


def unescape_html(c, unended: bool = True) -> Column:
    """Character references decoded in one pass: decimal, hexadecimal and all HTML5 names.

    As in HTML5, some need no semicolon; with `unended` off, what lacks it (a text that was cut, say) stays as it is.
    """
    text = col(c)
    whole, short, bare = _names()
    named = F.from_json(F.lit(whole), "array<map<string,string>>")
    loose = F.from_json(F.lit(short), "array<map<string,string>>")

    def point(digits: Column, base: int) -> Column:
        plain = F.ltrim(digits, F.lit("0"))  # of too many digits: beyond the last character anyway
        return _code_point(F.when(F.length(plain) > 9, F.lit(0x110000)).otherwise(F.coalesce(F.conv(plain, base, 10).cast("bigint"), F.lit(0))))

    def decode(piece: Column) -> Column:
        return F.when(piece.startswith("&#"), number(piece)).when(piece.startswith("&"), word(piece)).otherwise(piece)

    def number(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#(?:[xX](?=[0-9a-fA-F]))?([0-9a-fA-F]+)", 1)
        hexed = piece.rlike(r"^&#[xX][0-9a-fA-F]")
        return (
            F.when(hexed, F.concat(point(digits, 16), F.regexp_replace(piece, r"^&#[xX][0-9a-fA-F]+;?", "")))
            .when(piece.rlike(r"^&#[0-9]"), F.concat(point(F.regexp_extract(piece, r"^&#([0-9]+)", 1), 10), F.regexp_replace(piece, r"^&#[0-9]+;?", "")))
            .otherwise(piece)
        )

    def word(piece: Column) -> Column:
        full = _named(named, F.regexp_extract(piece, r"^&([A-Za-z][A-Za-z0-9]*);", 1))
        part = _named(loose, F.regexp_extract(piece, f"^&({bare})", 1))
        return F.coalesce(
            F.concat(full, F.regexp_replace(piece, r"^&[A-Za-z0-9]+;", "")),
            *([F.concat(part, F.regexp_replace(piece, f"^&({bare});?", ""))] if unended else []), piece)

    pieces = F.split(text, _BEGUN if unended else _ENDED)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")).otherwise(text)


def html_text(c, unended: bool = True) -> Column:
    """Visible text: script/style dropped, tags removed, entities decoded (see unescape_html), spaces collapsed."""
    no_code = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " ")
    no_comment = F.regexp_replace(no_code, r"(?s)<!--.*?-->", " ")
    return normalize_space(unescape_html(F.regexp_replace(no_comment, r"(?s)<[^>]+>", " "), unended))


def html_lines(c) -> Column:
    """HTML -> array of non-blank lines (`br`, `/p`, `/div`, `/li` end a line)."""
    broken = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?i)<br\s*/?>|</p>|</div>|</li>", "\n")
    plain = unescape_html(F.regexp_replace(broken, r"(?s)<[^>]+>", ""))
    return F.filter(F.transform(F.split(plain, "\n"), lambda x: F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), lambda x: x != "")


def label_pairs(c) -> Column:
    """array<struct<line, key, value>> of the lines, split at the first `:`; key and
    value are blank in a line without a label."""
    def split(line: Column) -> Column:
        at = F.instr(line, ":")
        return F.struct(
            line.alias("line"), F.trim(F.substring_index(line, ":", 1)).alias("key"),
            F.when(at > 0, F.trim(F.substring(line, at + 1, F.length(line)))).otherwise(F.lit("")).alias("value"),
        )

    return F.transform(html_lines(c), split)


def is_labeled(pair: Column) -> Column:
    return (pair["key"] != "") & (pair["value"] != "")


def labeled_fields(c) -> Column:
    """HTML -> map(label -> value); labels lower-cased without spaces, last one wins."""
    return fields_of(label_pairs(c))


def fields_of(pairs: Column) -> Column:
    """Labelled pairs -> map(label -> value)."""
    return entries_last_wins(
        F.transform(
            F.filter(pairs, is_labeled),
            lambda p: F.struct(
                F.replace(F.lower(p["key"]), F.lit(" "), F.lit("")).alias("key"), p["value"].alias("value")
            ),
        )
    )


def entries_last_wins(pairs: Column) -> Column:
    """array<struct<key,value>> -> map, keeping the last value of a repeated key."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.aggregate(
        pairs, empty,
        lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, v: k != x["key"]), F.create_map(x["key"], x["value"])),
    )


def labeled_value(html, label: str) -> Column:
    """Text after the first `label:` up to the next tag or line end; '' when absent."""
    found = F.regexp_extract(unescape_html(F.coalesce(col(html), F.lit(""))), re.escape(label) + r":\s*([^<\n]+)", 1)
    return normalize_space(found)


def first_unlabeled(c, min_chars: int = 24) -> Column:
    """First line that is not `label: value` and has at least `min_chars` characters."""
    return unlabeled_of(label_pairs(c), min_chars)


def unlabeled_of(pairs: Column, min_chars: int = 24) -> Column:
    """First long line of the pairs without a label."""
    found = F.filter(pairs, lambda p: ~is_labeled(p) & (F.length(p["line"]) >= min_chars))
    return F.coalesce(F.get(found, 0)["line"], F.lit(""))


def keep_paragraphs(paragraphs, drop_prefixes: list[str]) -> Column:
    """Array of paragraphs -> one text, without credit/download lines."""
    cleaned = F.transform(col(paragraphs), normalize_space)

    def wanted(x: Column) -> Column:
        low = F.lower(x)
        keep = x != ""
        for prefix in drop_prefixes:
            keep = keep & ~low.startswith(prefix)
        return keep

    return F.array_join(F.filter(cleaned, wanted), "\n\n")


def split_meta_line(c) -> Column:
    """`type • genre Status: x` -> struct(type_label, genre_label, status)."""
    text = normalize_space(c)
    parts = F.split(text, "Status:")
    left = F.split(F.trim(F.get(parts, 0)), "•")
    return F.struct(
        normalize_space(F.get(left, 0)).alias("type_label"),
        normalize_space(F.get(left, 1)).alias("genre_label"),
        normalize_space(F.get(parts, 1)).alias("status"),
    )


def extract_urls(c) -> Column:
    """Distinct http(s) URLs in first-seen order, trailing backslashes removed."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"""https?://[^\s"'<>]+"""), F.lit(0))
    return F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"\\+$", "")))


def tokens(*cols) -> Column:
    """Distinct lower-cased letter/digit tokens of the given columns (no stemming)."""
    joined = F.lower(F.concat_ws(" ", *[col(c) for c in cols]))
    return F.array_distinct(F.filter(F.split(joined, r"[^\p{L}\p{N}]+"), lambda t: t != ""))
