"""Text expressions: cleaning, tokens, n-grams, keys. All are Column -> Column and stay in the JVM."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import GROUP_LABELS, INVISIBLE, OUR, COMPETITOR, TOKEN

def unicode_trim(c: Column) -> Column:
    """Without leading and trailing Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@cache
def _entity_tables() -> tuple[str, str, str]:
    """JSON maps: every name of HTML 5, the names that count without a semicolon, and numbers that stand for other characters."""
    numbers = {0: "\ufffd", 13: "\r"} | {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    # a map is looked through from its first name on, and the common names are short
    return json.dumps(dict(sorted(html5.items(), key=lambda x: len(x[0])))), json.dumps({k: v for k, v in html5.items() if not k.endswith(";")}), json.dumps({str(k): v for k, v in numbers.items()})


def decode_entities(c: Column) -> Column:
    """Character references decoded in one pass, as HTML 5 has it: all names, by their longest known beginning where a
    semicolon is missing, and numbers; what is no reference stays. Two constant maps and one split of the text."""
    names, short, numbers = (F.from_json(F.lit(x), "map<string,string>") for x in _entity_tables())

    def number(ref: Column) -> Column:
        digits = F.regexp_replace(ref, r"^&#[xX]?0*|;$", "")
        hexa = ref.rlike("^&#[xX]")
        # longer ones are beyond the last code point
        code = F.when(digits == "", 0).when(F.char_length(digits) > 7, 1114112).when(hexa, F.conv(digits, 16, 10).cast("long")).otherwise(digits.cast("long"))
        pad = lambda n: F.lpad(F.hex(n), 4, "0")
        high = code - 65536
        units = F.when(code < 65536, pad(code)).otherwise(F.concat(pad(F.lit(55296) + F.shiftright(high, 10)), pad(F.lit(56320) + F.pmod(high, F.lit(1024)))))
        none = code.between(1, 8) | (code == 11) | code.between(14, 31) | code.between(127, 159) | code.between(0xFDD0, 0xFDEF) | (F.pmod(code, F.lit(65536)) >= 0xFFFE)
        out = F.when((code > 1114111) | code.between(55296, 57343), "\ufffd").when(none, "").otherwise(F.decode(F.unhex(units), "UTF-16BE"))
        return F.coalesce(F.try_element_at(numbers, code.cast("string")), out)

    def named(ref: Column) -> Column:
        name = F.substring(ref, 2, 33)
        begin = lambda n: F.concat(F.try_element_at(short, F.substring(name, 1, n)), F.substring(name, n + 1, 33))
        longest = max(map(len, json.loads(_entity_tables()[1])))
        return F.coalesce(F.try_element_at(names, name), *[begin(n) for n in range(longest, 1, -1)], ref)

    found = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    decoded = F.transform(found, lambda r: F.when(r.startswith("&#"), number(r)).otherwise(named(r)))
    gaps = F.split(c, _REFERENCE, -1)
    return F.array_join(F.zip_with(gaps, decoded, lambda g, d: F.concat(g, F.coalesce(d, F.lit("")))), "")


def strip_html(c: Column) -> Column:
    """Tags go without a trace, then references are decoded, then white space around goes; null gives ''."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", "")
    return unicode_trim(F.when(F.contains(bare, F.lit("&")), decode_entities(bare)).otherwise(bare))


def strip_html_named(c: Column, references: Mapping[str, str]) -> Column:
    """Tags go without a trace, then blanks, tabs and line ends around; of references only the given ones are decoded, in
    their order, whole ones with their semicolon; null stays null."""
    bare = F.btrim(F.regexp_replace(c, "<[^>]+>", ""), F.lit(" \t\n\r"))
    for name, value in references.items():
        bare = F.replace(bare, F.lit(name), F.lit(value))
    return bare


def clean_markup(c: Column) -> Column:
    """For comparing: tags to spaces, &quot; to space, &amp; to &, white space runs to one space, trimmed."""
    x = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")
    x = F.replace(F.replace(x, F.lit("&quot;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def clean_invisible(c: Column) -> Column:
    """Without byte-order marks, zero-width and control characters, trimmed; null gives ''."""
    return unicode_trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), INVISIBLE, ""))


def is_blank(c: Column) -> Column:
    return clean_invisible(c) == ""


def non_blank(c: Column) -> Column:
    """The cleaned value, or null where it is blank."""
    return F.nullif(clean_invisible(c), F.lit(""))


def tokens(c: Column, least: int = 2) -> Column:
    """Distinct tokens (Hangul, ASCII letters, digits) of at least ``least`` characters, lower-cased."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.array_distinct(F.filter(found, lambda x: F.char_length(x) >= least))


def summary_tokens(c: Column) -> Column:
    """Distinct words between white space."""
    x = unicode_trim(F.coalesce(c, F.lit("")))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(x, r"(?U)\s+")))


def char_grams(c: Column, low: int = 3, high: int = 5) -> Column:
    """All character n-grams of the lower-cased text, runs of white space as one space."""
    x = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s\s+", " ")
    none = F.array().cast("array<string>")

    def of(t: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.char_length(t) - (n - 1))
        return F.when(F.char_length(t) >= n, F.transform(starts, lambda i: F.substr(t, i, F.lit(n)))).otherwise(none)

    # the text goes in as a lambda's variable: written out in the inner lambda it would be computed for every gram
    return F.flatten(F.transform(F.array(x), lambda t: F.flatten(F.array(*[of(t, n) for n in range(low, high + 1)]))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 if either is empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(0.0))


def article_id(link: Column) -> Column:
    return F.when(is_blank(link), "").otherwise(F.substring(F.md5(link), 1, 12))


def domain(url: Column) -> Column:
    """Authority without every ``www.``; case, port and user stay; '' where there is no authority."""
    return F.replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("www."), F.lit(""))


def media_key(media_domain: Column, link: Column) -> Column:
    own = F.lower(F.trim(F.coalesce(media_domain, F.lit(""))))
    host = F.regexp_extract(F.coalesce(link, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.when(~own.isin("", "nan"), own).otherwise(F.lower(host))


def normalise_group(c: Column) -> Column:
    x = F.trim(c)
    labels = F.create_map(*[F.lit(v) for pair in GROUP_LABELS.items() for v in pair])
    return F.coalesce(labels[x], x)


def is_our_group(c: Column) -> Column:
    return F.coalesce(normalise_group(c) == OUR, F.lit(False))


def is_competitor_group(c: Column) -> Column:
    return F.coalesce(normalise_group(c) == COMPETITOR, F.lit(False))


def query_prefix(c: Column) -> Column:
    return F.substring_index(c, "|", 1)


def cluster_label(prefix: Column, kind: str, n: Column) -> Column:
    """``{prefix}_{kind}00001``, at least five digits."""
    digits = n.cast("string")
    return F.concat(prefix, F.lit(f"_{kind}"), F.when(F.char_length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits))


def cluster_number(c: Column, kind: str) -> Column:
    """The number of a cluster id of that kind, or null."""
    return F.nullif(F.regexp_extract(c, f"_{kind}([0-9]+)$", 1), F.lit("")).try_cast("bigint")


def header_key(name: str) -> str:
    """A column name for comparing: invisible characters and case don't count."""
    import re

    pattern = INVISIBLE.replace(r"\x{", r"\u{")
    pattern = re.sub(r"\\u\{([0-9a-f]{4})\}", r"\\u\1", pattern)
    return re.sub(pattern, "", name or "").strip().lower()


def find_column(names: Iterable[str], candidates: Sequence[str]) -> str | None:
    """The first of ``names`` that is the first possible of ``candidates``, compared by ``header_key``; None if none is."""
    known: dict[str, str] = {}
    for n in names:
        known.setdefault(header_key(n), n)
    return next((known[header_key(c)] for c in candidates if header_key(c) in known), None)


def column_letter(n: int) -> str:
    """1 -> A, 27 -> AA."""
    out = ""
    while n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def render(template: str, values: dict[str, object]) -> str:
    """``{{name}}`` places filled in; unknown names stay."""
    for k, v in values.items():
        template = template.replace("{{" + k + "}}", "" if v is None else str(v))
    return template
