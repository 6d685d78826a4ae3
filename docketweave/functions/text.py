"""Name, contact and date functions, as Column expressions that stay inside code generation.

Empty and blank strings count as missing everywhere (nz). All take and give columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Honorifics, legal suffixes, generational suffixes and legal-form families.
HONORIFICS = ["the honorable", "honorable", "hon", "chief judge", "magistrate judge", "judge", "justice", "mr", "mrs", "ms", "dr"]
CORP_SUFFIXES = ["inc", "incorporated", "corp", "corporation", "co", "company", "llc", "llp", "lp", "ltd", "limited", "pllc", "pc", "pa", "plc"]
GENERATIONS = ["jr", "sr", "ii", "iii", "iv"]
LEGAL_FORMS = {"llc": r"l\.?l\.?c\.?|limited liability company", "llp": r"l\.?l\.?p\.?", "lp": r"l\.?p\.?|limited partnership", "inc": r"inc\.?|incorporated", "corp": r"corp\.?|corporation", "ltd": r"ltd\.?|limited", "co": r"co\.?|company"}
OFFICE_CLASSES = [("public_defender", r"public defender"), ("law_firm", r"law offices?|legal group|\b(llp|pllc|p\.?c\.?|p\.?a\.?)\b|associates"), ("government", r"department|county|state of|united states"), ("corporate", r"\b(inc|corp|corporation|company|llc|ltd|l\.p)\b")]


def nz(c: Column | str) -> Column:
    """Trimmed text, or null where nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c), F.lit(""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_honorifics(c: Column, titles: list[str] = HONORIFICS) -> Column:
    """Leading and trailing titles, longest first, to the fixed point."""
    alt = "|".join(re.escape(t) for t in sorted(titles, key=len, reverse=True))
    low = squeeze(F.lower(c))
    lead = F.regexp_replace(low, rf"^(?:(?:{alt})[ .]+)+", "")
    tail = F.regexp_replace(lead, rf"(?:[ ,.]+(?:{alt})\.?)+$", "")
    return F.trim(F.regexp_replace(tail, rf"^(?:{alt})\.?$", ""))


def strip_corp_suffixes(c: Column, suffixes: list[str] = CORP_SUFFIXES) -> Column:
    """Trailing legal suffixes, never the whole name: each needs a space before it."""
    alt = "|".join(re.escape(s) for s in sorted(suffixes, key=len, reverse=True))
    return F.regexp_replace(F.trim(c), rf"(?i)(?:[ ,.]* (?:{alt})\.?)+$", "")


def corp_core(c: Column, max_tokens: int = 4) -> Column:
    """Lower case, dashes as spaces, without legal suffixes, the first tokens."""
    flat = squeeze(F.regexp_replace(F.lower(c), "[-–—]", " "))
    return F.array_join(F.slice(F.split(strip_corp_suffixes(flat), " "), 1, max_tokens), " ")


def tokens(c: Column) -> Column:
    return F.filter(F.split(squeeze(F.lower(c)), " "), lambda t: t != "")


def initials(c: Column) -> Column:
    return F.array_join(F.transform(tokens(c), lambda t: F.substring(t, 1, 1)), "|")


def core_tokens(c: Column) -> Column:
    """Tokens without generational suffixes."""
    return F.filter(tokens(c), lambda t: ~t.isin(GENERATIONS))


def surname(c: Column) -> Column:
    return F.try_element_at(core_tokens(c), F.lit(-1))


def surname_keys(c: Column) -> Column:
    """The last token and, if it is hyphenated, its parts of two letters or more."""
    last = surname(c)
    parts = F.when(last.contains("-"), F.filter(F.split(last, "-"), lambda p: F.length(p) >= 2)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(last), parts))


def presentable(c: Column) -> Column:
    """Every run of letters with one capital, the rest small."""
    runs = F.regexp_extract_all(c, F.lit(r"([\p{L}\p{M}]+|[^\p{L}\p{M}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 10_000)))), "")


def punct_fold_keys(c: Column) -> Column:
    """Keys under which punctuation variants of a name meet: its words, their concatenation (6 letters or more)."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " ")), " "), lambda t: ~t.isin("and", "the", "of", ""))
    joined = F.array_join(words, "")
    return F.concat(F.array(F.concat(F.lit("tok:"), F.array_join(words, " "))), F.when(F.length(joined) >= 6, F.array(F.concat(F.lit("join:"), joined))).otherwise(F.array().cast("array<string>")))


def name_core(c: Column) -> Column:
    """Corroboration core: & as and, no articles, no legal suffix."""
    flat = squeeze(F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), "-", " "))
    flat = squeeze(F.regexp_replace(flat, r"\b(the|a|an)\b", " "))
    return strip_corp_suffixes(F.regexp_replace(flat, r"\bmfg\b", "manufacturing"))


def legal_form(raw: Column) -> Column:
    """Family of the legal form that ends a raw name; one token at least must stand before it."""
    low = squeeze(F.lower(raw))
    out = F.lit(None).cast("string")
    for family, pattern in reversed(LEGAL_FORMS.items()):
        out = F.when(low.rlike(rf"[ ,](?:{pattern})$"), F.lit(family)).otherwise(out)
    return out


def office_class(name: Column) -> Column:
    low = F.lower(name)
    out = F.lit("other")
    for label, pattern in reversed(OFFICE_CLASSES):
        out = F.when(low.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def email_domain(c: Column) -> Column:
    return F.when(c.contains("@"), nz(F.lower(F.substring_index(c, "@", -1))))


def phone_key(c: Column) -> Column:
    d = F.regexp_replace(c, "[^0-9]", "")
    d = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    return F.when(F.length(d) >= 7, d)


def domain_key(c: Column) -> Column:
    return nz(F.regexp_replace(F.lower(F.trim(c)), r"^www\.", ""))


def address_key(c: Column) -> Column:
    a = squeeze(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", ""))
    return F.when(F.length(a) >= 8, a)


def year_of(c: Column) -> Column:
    return F.regexp_extract(c, r"((?:19|20)[0-9]{2})", 1).try_cast("int")


def iso_date(c: Column) -> Column:
    """yyyy-mm-dd from yyyy-m-d or m/d/yyyy, months and days padded; null for others."""
    us, iso = r"^\s*([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\s*$", r"^\s*([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\s*$"
    part = lambda p, i: F.lpad(F.regexp_extract(c, p, i), 4 if (p, i) in ((us, 3), (iso, 1)) else 2, "0")
    dashed = lambda p, *order: F.concat(part(p, order[0]), F.lit("-"), part(p, order[1]), F.lit("-"), part(p, order[2]))
    return F.when(c.rlike(us), dashed(us, 3, 1, 2)).when(c.rlike(iso), dashed(iso, 1, 2, 3))


def office_geo(address: Column) -> Column:
    """city|ST of the lowest line that ends in one."""
    lines = F.reverse(F.split(address, "\n"))
    found = F.filter(F.transform(lines, lambda s: F.regexp_extract(s, r"^\s*([A-Za-z .'-]+), ([A-Z]{2})(?: [0-9-]+)?\s*$", 0)), lambda s: s != "")
    line = F.try_element_at(found, F.lit(1))
    pattern = r"^\s*([A-Za-z .'-]+), ([A-Z]{2})(?: [0-9-]+)?\s*$"
    return F.when(line.isNotNull(), F.concat(F.lower(F.regexp_extract(line, pattern, 1)), F.lit("|"), F.regexp_extract(line, pattern, 2)))


def mention_key(*parts: Column) -> Column:
    """Stable id of a mention: missing parts count as empty, so positions never shift."""
    return F.concat(F.lit("mnt_"), F.substring(F.sha1(F.array_join(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), "|")), 1, 16))
