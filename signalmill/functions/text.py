"""Text rules as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import CITY_STATES, JUNK_PHRASES, STATE_NAMES, TRACKING
from .parse import strip

#: The longest suffix that counts as a publisher's name.
SUFFIX = 60


def normalised_title(c: Column) -> Column:
    """Lower case, punctuation to spaces, spaces collapsed."""
    words = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^\w\s]", " ")
    return strip(F.regexp_replace(words, r"(?U)\s+", " "))


def dedup_title(c: Column) -> Column:
    """``normalised_title`` without a publisher after the last `` | `` or, where there is none, `` - ``; a long suffix stays."""
    title = F.coalesce(c, F.lit(""))

    def cut(sep: str) -> Column:
        suffix = F.substring_index(title, sep, -1)
        short = F.length(strip(suffix)) <= SUFFIX
        return F.when(short, title.substr(F.lit(1), F.length(title) - F.length(suffix) - len(sep))).otherwise(title)

    bare = F.when(title.contains(" | "), cut(" | ")).when(title.contains(" - "), cut(" - ")).otherwise(title)
    return normalised_title(bare)


def title_fingerprint(c: Column) -> Column:
    return F.sha2(normalised_title(c), 256)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once, as a lambda's variable, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: First letters that an expression tries together.
GROUPED = 5


def factored(terms: Iterable[str]) -> str:
    """A regular expression for any of the terms, the longest first, with their common beginnings written once; many beginnings are tried in groups."""
    heads: dict[str, list[str]] = {}
    for t in terms:
        if t:
            heads.setdefault(t[0], []).append(t[1:])
    parts = [re.escape(c) + factored(rest) for c, rest in sorted(heads.items())]
    if len(parts) > 2 * GROUPED:
        letters = [re.escape(c) for c in sorted(heads)]
        parts = [f"(?=[{''.join(letters[i : i + GROUPED])}])(?:{'|'.join(parts[i : i + GROUPED])})" for i in range(0, len(parts), GROUPED)]
    body = parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"
    return body if "" not in terms else f"(?:{body})?" if heads else ""


#: Sentences that are cut off a text at first; only texts in which these don't suffice are cut to the end.
FIRST_PIECES = 12


def _sentences(text: Column, n: int, use: Callable[[Column], Column]) -> Column:
    """``use`` of the sentences of more than 25 characters: of the first ones if there are ``n`` among them, else of all."""
    def kept(pieces: Column) -> Column:
        return F.filter(F.transform(pieces, strip), lambda s: F.length(s) > 25)

    def all_of(text: Column) -> Column:
        few = kept(F.slice(F.split(text, r"(?<=[.!?])\s+", FIRST_PIECES + 1), 1, FIRST_PIECES))
        return bound(few, lambda x: F.when(F.size(x) >= n, x).otherwise(kept(F.split(text, r"(?<=[.!?])\s+"))))

    return bound(all_of(text), use)


def first_sentences(c: Column, n: int, fallback: Column | None = None) -> Column:
    """The first n sentences of more than 25 characters; without one the first 500 characters; of an empty text the fallback."""
    empty = F.coalesce(fallback if fallback is not None else F.lit(""), F.lit(""))

    def of(text: Column) -> Column:
        return F.when(text == "", empty).otherwise(_sentences(text, n, lambda s: F.when(F.size(s) > 0, F.array_join(F.slice(s, 1, n), " ")).otherwise(F.substring(text, 1, 500))))

    return bound(strip(F.coalesce(c, F.lit(""))), of)


def summary(c: Column, description: Column, n: int = 3) -> Column:
    """The first n sentences of more than 25 characters; of a text with fewer than two, the description."""
    short = F.coalesce(description, F.lit(""))
    return bound(strip(F.coalesce(c, F.lit(""))), lambda text: _sentences(text, n, lambda s: F.when(F.size(s) >= 2, F.array_join(F.slice(s, 1, n), " ")).otherwise(short)))


def snippet(c: Column) -> Column:
    """A feed's description without tags and a few entities."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]+>", "")
    out = F.replace(F.replace(out, F.lit("&amp;"), F.lit("&")), F.lit("&quot;"), F.lit('"'))
    return strip(F.regexp_replace(out, r"&#\d+;", ""))


def body_lines(c: Column) -> Column:
    """Lines of 20 characters or more without junk phrases."""
    def good(line: Column) -> Column:
        out = F.length(line) >= 20
        for phrase in JUNK_PHRASES:
            out = out & ~F.lower(line).contains(phrase)
        return out

    return F.array_join(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), strip), good), "\n")


def states(c: Column, cities: bool = False) -> Column:
    """Sorted codes of the states that are named anywhere in the text, or stand in it as codes in capitals."""
    text = F.coalesce(c, F.lit(""))
    names = {name.lower(): code for name, code in (STATE_NAMES | (CITY_STATES if cities else {})).items()}
    # one pass: at every place the longest name that begins there, which stands for all names that it begins with
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?=({factored(list(names))}))"), F.lit(1)))
    codes = F.create_map(*(F.lit(x) for name in names for x in (name, ",".join(sorted({code for other, code in names.items() if name.startswith(other)})))))
    named = F.flatten(F.transform(found, lambda x: F.split(codes[x], ",")))
    pairs = F.filter(F.regexp_extract_all(text, F.lit(r"(?U)(?=[A-Z]{2})\b([A-Z]{2})\b"), F.lit(1)), lambda x: x.isin(*sorted(set(STATE_NAMES.values()))))
    return F.array_sort(F.array_distinct(F.concat(named, pairs)))


def canonical_url(c: Column) -> Column:
    """Without fragment, tracking and blank parameters, the rest grouped by key at its first place; lower case, no slash at the end."""
    url = strip(c)
    whole = F.regexp_extract(url, r"^([^#]*)", 1)
    base, query = F.regexp_extract(whole, r"^([^?]*)", 1), F.regexp_extract(whole, r"^[^?]*\?(.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]+=.+$") & ~F.lower(F.regexp_extract(p, r"^([^=]*)", 1)).isin(*TRACKING))
    keys = F.array_distinct(F.transform(pairs, lambda p: F.regexp_extract(p, r"^([^=]*)", 1)))
    grouped = F.flatten(F.transform(keys, lambda k: F.filter(pairs, lambda p: F.regexp_extract(p, r"^([^=]*)", 1) == k)))
    # a space in a value is written as a plus sign
    text = F.replace(F.array_join(grouped, "&"), F.lit("%20"), F.lit("+"))
    return F.regexp_replace(F.lower(F.when(text == "", base).otherwise(F.concat(base, F.lit("?"), text))), "/+$", "")


def unfenced(c: Column) -> Column:
    """A model's answer without Markdown fences around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"^```(?:json)?\s*", ""), r"\s*```$", ""))


def xml_escaped(c: Column) -> Column:
    out = F.coalesce(c.cast("string"), F.lit(""))
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(name))
    return out


def mw_label(c: Column) -> Column:
    return F.when(c > 0, F.concat(F.format_number(c, 1), F.lit(" MW"))).otherwise("")


def sqft_label(c: Column) -> Column:
    return F.when(c > 0, F.concat(F.format_number(F.bround(c, 0), 0), F.lit(" sqft"))).otherwise("")


def scaled_number(c: Column) -> Column:
    """1.2K, 3.4M, 5.6B."""
    def part(limit: float, unit: str) -> Column:
        return F.concat(F.format_string("%.1f", c / limit), F.lit(unit))

    return F.when(c >= 1e9, part(1e9, "B")).when(c >= 1e6, part(1e6, "M")).when(c >= 1e3, part(1e3, "K")).otherwise(F.floor(c + 0.5).cast("string"))


def power_label(c: Column) -> Column:
    """MW, or GW from a thousand on; empty for null and 0."""
    return F.when(c.isNull() | (c == 0), "").when(c >= 1000, F.concat(F.format_string("%.1f", c / 1000), F.lit("GW"))).otherwise(F.concat(F.floor(c + 0.5).cast("string"), F.lit("MW")))


def slug(c: Column) -> Column:
    return F.translate(F.lower(c), " /", "__")


def kml_colour(c: Column, alpha: int = 128) -> Column:
    """#RRGGBB as AABBGGRR."""
    h = F.upper(F.regexp_replace(c, "^#", ""))
    return F.concat(F.lit(f"{alpha:02X}"), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))


def rgb(c: Column) -> Column:
    h = F.regexp_replace(c, "^#", "")
    return F.array(*(F.conv(F.substring(h, k, 2), 16, 10).cast("int") for k in (1, 3, 5)))


def article_id(url: Column) -> Column:
    """A stable id of a url; clock-made ids can't be made again."""
    return F.concat(F.lit("ART-"), F.substring(F.sha2(url, 256), 1, 16))


def feed_source(title: Column, tags: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), F.get(tags, F.lit(0)), F.lit(""))
