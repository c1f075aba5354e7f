"""Text and key expressions used by the jobs. All are plain Column expressions, no Python per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Scripts, number shapes and endings.
HANGUL = "[가-힣㄰-㆏]"
HAN = "[一-鿿㐀-䶿]"
KANA = "[぀-ヿ]"
HAN_OR_KANA = "[一-鿿㐀-䶿぀-ヿ]"
NUMBER = r"-?\d[\d,]*\.?\d*"
NUMBER_WITH_UNIT = (
    r"(-?\d[\d,]*\.?\d*)\s*(%p|%|퍼센트|bp|포인트|조\s?원|억\s?원|억\s?달러|조\s?달러|원|달러|\$)"
)
POLITE = "(요|에요|예요)[\\s.!~…'\"”’)]*$"
EXCLAIMED = r"!\s*$"
TRACKING = "(?i)^(utm_[a-z]+|fbclid|gclid|cmpid|ref)$"
HANJA = [
    ("中國", "중국"), ("日本", "일본"), ("北韓", "북한"), ("韓國", "한국"),
    ("美國", "미국"), ("英國", "영국"), ("獨逸", "독일"), ("佛蘭西", "프랑스"),
    ("美", "미국"), ("中", "중국"), ("日", "일본"), ("北", "북한"),
    ("韓", "한국"), ("英", "영국"), ("獨", "독일"), ("佛", "프랑스"), ("露", "러시아"),
]
ZONES = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_empty(c) -> Column:
    return F.coalesce(col(c), F.lit(""))


def canonical_url(url) -> Column:
    """Lower-case scheme and host, no tracking parameters, no fragment; other parameters re-encoded."""
    u = F.trim(or_empty(url))
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    host = F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)

    def reencode(piece: Column) -> Column:
        plain = F.coalesce(F.try_url_decode(piece), piece)
        return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    def name_of(pair: Column) -> Column:
        return F.regexp_extract(pair, "^([^=]*)", 1)

    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~name_of(p).rlike(TRACKING))
    pairs = F.transform(
        pairs, lambda p: F.concat(reencode(name_of(p)), F.lit("="), reencode(F.regexp_extract(p, "=(.*)$", 1)))
    )
    kept = F.array_join(pairs, "&")
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")),
        path,
        F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")),
    )


def url_id(url) -> Column:
    return F.sha1(F.encode(canonical_url(url), "UTF-8"))


def squeeze(text) -> Column:
    return F.trim(F.regexp_replace(or_empty(text), r"\s+", " "))


def lead_of(text, limit: int = 200) -> Column:
    """The stored lead: whitespace collapsed, at most `limit` characters."""
    return F.substring(squeeze(text), 1, limit)


def strip_tags(text) -> Column:
    return squeeze(F.regexp_replace(or_empty(text), "<[^>]+>", " "))


def has_han_or_kana(text) -> Column:
    return or_empty(text).rlike(HAN_OR_KANA)


def is_foreign(title) -> Column:
    """Headline in a script other than Hangul or Latin."""
    t = or_empty(title)
    han = F.regexp_count(t, F.lit(HAN))
    latin = F.regexp_count(t, F.lit("[A-Za-z]"))
    return (
        F.when(t.rlike(HANGUL), F.lit(False))
        .when(t.rlike(KANA), F.lit(True))
        .when(han >= 4, F.lit(True))
        .otherwise((han > latin) & (han >= 2))
    )


def hanja_to_hangul(text) -> Column:
    out = or_empty(text)
    for han, hangul in HANJA:
        out = F.replace(out, F.lit(han), F.lit(hangul))
    return out


def number_tags(text) -> Column:
    t = or_empty(text)
    values = F.regexp_extract_all(t, F.lit(NUMBER_WITH_UNIT), F.lit(1))
    units = F.regexp_extract_all(t, F.lit(NUMBER_WITH_UNIT), F.lit(2))
    return F.zip_with(values, units, lambda v, u: F.concat(v, F.replace(u, F.lit(" "), F.lit(""))))


def numbers_in(text) -> Column:
    """Distinct numbers, thousands separators removed, six decimals; a hyphen counts as a minus sign."""
    found = F.regexp_extract_all(or_empty(text), F.lit(NUMBER), F.lit(0))
    values = F.transform(
        found, lambda x: F.round(F.replace(x, F.lit(","), F.lit("")).try_cast("double"), 6)
    )
    return F.array_distinct(F.array_compact(values))


def is_free_number(n: Column) -> Column:
    """Years and small counts need no source."""
    whole = n == F.floor(n)
    return (n.between(1900, 2100) & whole) | (n.between(0, 12) & whole)


def parse_time(text) -> Column:
    """RFC 822 or ISO 8601 to a UTC timestamp; naive values are UTC; null when unreadable."""
    return bind(F.trim(or_empty(text)), _time_of)


def _time_of(s: Column) -> Column:
    mail = F.regexp_replace(s, r"^[A-Za-z]{3,9},?\s+", "")
    for name, offset in ZONES.items():
        mail = F.regexp_replace(mail, rf"\s{name}$", f" {offset}")
    # a format that does not fit costs an exception, so only a text that begins like a date of RFC 822 is tried as one
    like_mail = s.rlike(r"^([A-Za-z]{3,9},?\s+)?-?[0-9]+ [^0-9]")
    return F.coalesce(
        F.when(like_mail, bind(mail, lambda m: F.coalesce(
            F.try_to_timestamp(m, F.lit("d MMM yyyy HH:mm:ss Z")),
            F.try_to_timestamp(m, F.lit("d MMM yyyy HH:mm Z")),
            F.try_to_timestamp(m, F.lit("d MMM yyyy HH:mm:ss")),
        ))),
        F.try_to_timestamp(s),
    )


def period_bucket(report_name, receipt_day) -> Column:
    """Quarter named in brackets as (YYYY.MM), otherwise the quarter of the receipt day yyyyMMdd."""
    pattern = r"\((\d{4})[.\s]*(\d{1,2})\)"
    name, day = or_empty(report_name), or_empty(receipt_day)
    named = name.rlike(pattern)
    year = F.when(named, F.regexp_extract(name, pattern, 1)).otherwise(F.substring(day, 1, 4))
    month = F.when(named, F.regexp_extract(name, pattern, 2)).otherwise(F.substring(day, 5, 2)).try_cast("int")
    return F.concat(year, F.lit("-"), (F.floor((month - 1) / 3) + 1).cast("string"), F.lit("Q"))


def safe_key(key) -> Column:
    return F.substring(F.regexp_replace(or_empty(key), "[^0-9A-Za-z가-힣._-]", "_"), 1, 150)


def hangul_share(text) -> Column:
    t = or_empty(text)
    visible = F.length(F.regexp_replace(t, r"\s", ""))
    return F.when(visible == 0, F.lit(0.0)).otherwise(F.regexp_count(t, F.lit("[가-힣]")) / visible)


def display_number(value) -> Column:
    v = col(value)
    whole = v == F.floor(v)
    return F.when(whole, F.format_number(v, 0)).otherwise(
        F.regexp_replace(F.format_number(v, 2), r"\.?0+$", "")
    )


def clip(text, limit: int) -> Column:
    """Cut at a word boundary when that keeps at least half of the limit; mark the cut with an ellipsis."""
    t = F.trim(or_empty(text))
    head = F.substring(t, 1, limit - 1)
    words = F.rtrim(F.regexp_extract(head, r"(?s)^(.*) ", 1))
    kept = F.when(head.contains(" ") & (F.length(words) >= limit // 2), words).otherwise(head)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.rtrim(kept), F.lit("…")))


def particle(word, with_final: str, without_final: str) -> Column:
    """Choose a particle by the final consonant of the last Hangul syllable (U+AC00 to U+D7A3)."""
    last = F.substring(or_empty(word), -1, 1)
    code = F.ascii(last)
    has_final = code.between(0xAC00, 0xD7A3) & ((code - 0xAC00) % 28 != 0)
    return F.when(has_final, F.lit(with_final)).otherwise(F.lit(without_final))


def is_polite(text) -> Column:
    return or_empty(text).rlike(POLITE)


def clip_sentence(text, limit: int = 55) -> Column:
    t = F.trim(or_empty(text))
    head = F.substring(t, 1, limit)
    before = F.regexp_extract(head, r"(?s)^(.*)[\s,·。.、]", 1)
    cut = F.when(F.length(before) >= limit // 2, before).otherwise(head)
    cut = F.regexp_replace(cut, "[ ,·、]+$", "")
    return F.when(F.length(t) <= limit, t).otherwise(
        F.when(cut.rlike(POLITE), cut).otherwise(F.concat(cut, F.lit("요.")))
    )


def rescued_json(text) -> Column:
    """JSON text as it is, or its outermost braces when noise surrounds it; null when neither parses."""
    t = or_empty(text)
    inner = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    return (
        F.when(F.try_parse_json(t).isNotNull(), t)
        .when(F.try_parse_json(inner).isNotNull() & (inner != ""), inner)
        .otherwise(F.lit(None).cast("string"))
    )


def matches_alias(text_lower: Column, alias: str) -> Column:
    """Aliases up to two characters need a boundary on both sides, longer ones match anywhere."""
    a = alias.lower()
    if len(a) <= 2:
        return text_lower.rlike(rf"(?<![0-9a-z]){re.escape(a)}(?![0-9a-z])")
    return text_lower.contains(a)


def bind(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def entity_keys(text, aliases: list[tuple[str, str]]) -> Column:
    """Dictionary keys found in the text, longest alias first, each key once.

    The dictionary is configuration of a few hundred rows, so it is part of the expression: one narrow
    pass, no join and no shuffle, whatever the size of the article table.
    """
    ordered = sorted(((str(a), k) for a, k in aliases), key=lambda pair: -len(pair[0]))
    if not ordered:
        return F.array().cast("array<string>")
    found = bind(
        F.lower(or_empty(text)), lambda t: F.array(*[F.when(matches_alias(t, a), F.lit(k)) for a, k in ordered])
    )
    return F.array_distinct(F.array_compact(found))


def surface_pattern(surfaces: list[str]) -> str:
    """Alternation that finds the leftmost, then longest surface: longer surfaces stand first."""
    kept = sorted({s.lower() for s in surfaces if len(s) >= 2}, key=lambda s: (-len(s), s))
    return "(" + "|".join(re.escape(s).replace("\\ ", " ").replace("\\-", "-") for s in kept) + ")"


def glossary_terms(text, surfaces: dict[str, str]) -> Column:
    """Canonical terms in order of first occurrence. `surfaces` maps a surface to its term."""
    usable = {s.lower(): term for s, term in surfaces.items() if len(s) >= 2}
    if not usable:
        return F.array().cast("array<string>")
    found = F.regexp_extract_all(F.lower(or_empty(text)), F.lit(surface_pattern(list(usable))), F.lit(1))
    pairs = [F.lit(x) for item in usable.items() for x in item]
    return F.array_distinct(F.transform(found, lambda s: F.element_at(F.create_map(*pairs), s)))
