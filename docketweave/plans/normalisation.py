"""Queries over single mentions: names, contacts, dates, classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketweave.functions import text as T
from docketweave.session import read


def _over_mentions(*columns, where: str | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = read(spark, sf_dir, "mentions")
        return (m.filter(where) if where else m).select("mention_id", *[c() for c in columns])

    return query


c = F.col
QUERIES = {
    "strip_honorifics": _over_mentions(lambda: T.strip_honorifics(c("raw_name")).alias("name"), where="entity_type = 'judge'"),
    "strip_corp_suffix": _over_mentions(lambda: T.strip_corp_suffixes(c("raw_name")).alias("name"), where="entity_type <> 'judge'"),
    "corp_core": _over_mentions(lambda: T.corp_core(c("raw_name")).alias("core"), where="entity_type <> 'judge'"),
    "name_tokens": _over_mentions(lambda: F.size(T.tokens(c("normalized_name"))).cast("int").alias("n_tokens"), lambda: T.initials(c("normalized_name")).alias("initials"), lambda: T.surname(c("normalized_name")).alias("last_name"), where="normalized_name is not null"),
    "surname_keys": _over_mentions(lambda: F.array_join(T.surname_keys(c("normalized_name")), ",").alias("keys"), where="entity_type <> 'firm' and normalized_name is not null"),
    "presentable_name": _over_mentions(lambda: T.presentable(c("raw_name")).alias("name")),
    "punct_fold_keys": _over_mentions(lambda: F.array_join(T.punct_fold_keys(c("normalized_name")), ",").alias("keys"), where="normalized_name is not null"),
    "name_core": _over_mentions(lambda: T.name_core(c("raw_name")).alias("core"), where="entity_type <> 'judge'"),
    "legal_form": _over_mentions(lambda: T.legal_form(c("raw_name")).alias("form"), where="entity_type <> 'judge'"),
    "classify_office": _over_mentions(lambda: T.office_class(c("raw_name")).alias("office_class"), where="entity_type <> 'judge'"),
    "email_domain": _over_mentions(lambda: T.email_domain(c("email")).alias("email_domain")),
    "contact_norm": _over_mentions(lambda: T.phone_key(c("phone")).alias("phone_key"), lambda: T.domain_key(c("domain")).alias("domain_key"), lambda: T.address_key(c("address")).alias("address_key")),
    "iso_dates": _over_mentions(lambda: T.iso_date(c("filing_date")).alias("filed_on"), lambda: T.year_of(c("filing_date")).alias("filed_year")),
    "office_geo": _over_mentions(lambda: T.office_geo(c("address")).alias("geo"), where="address is not null"),
    "mention_ids": _over_mentions(lambda: T.mention_key(c("ucid"), c("docket_source"), c("raw_name"), c("party_enum"), c("judge_enum"), c("docket_index"), c("role"), c("counsel_enum")).alias("key")),
    "profile_text": _over_mentions(lambda: F.concat_ws(" | ", T.nz("presentable_name"), T.nz("court"), T.nz("role"), T.nz("office_name"), T.nz("domain")).alias("profile")),
}

_TITLES = "the honorable|magistrate judge|chief judge|honorable|justice|judge|hon|mrs|mr|ms|dr"
_SUFFIX = "incorporated|corporation|company|limited|corp|pllc|inc|llc|llp|ltd|plc|co|lp|pc|pa"
_GEO = r"^\s*([A-Za-z .''-]+), ([A-Z]{2})(?: [0-9-]+)?\s*$"


def _squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def _tokens(x: str) -> str:
    return f"list_filter(string_split({_squeeze(f'lower({x})')}, ' '), lambda t: t <> '')"


_CORE = _tokens("normalized_name").join(["list_filter(", ", lambda t: t NOT IN ('jr', 'sr', 'ii', 'iii', 'iv'))"])
_FOLD = "list_filter(string_split(trim(regexp_replace(lower(normalized_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: t NOT IN ('and', 'the', 'of', ''))"
_NAME_CORE = _squeeze("regexp_replace(" + _squeeze("regexp_replace(replace(lower(raw_name), '&', ' and '), '-', ' ', 'g')") + r", '\b(the|a|an)\b', ' ', 'g')")


def _form_case() -> str:
    from docketweave.functions.text import LEGAL_FORMS

    low = _squeeze("lower(raw_name)")
    return "CASE " + " ".join(f"WHEN regexp_matches({low}, '[ ,](?:{p})$') THEN '{f}'" for f, p in LEGAL_FORMS.items()) + " END"


def _class_case() -> str:
    from docketweave.functions.text import OFFICE_CLASSES

    return "CASE " + " ".join(f"WHEN regexp_matches(lower(raw_name), '{p}') THEN '{f}'" for f, p in OFFICE_CLASSES) + " ELSE 'other' END"


_STRIP_CORP = rf"regexp_replace(trim({{}}), '(?:[ ,.]* (?:{_SUFFIX})\.?)+$', '', 'i')"
_PHONE = "regexp_replace(phone, '[^0-9]', '', 'g')"
_PHONE11 = f"CASE WHEN length({_PHONE}) = 11 AND starts_with({_PHONE}, '1') THEN substr({_PHONE}, 2, 10) ELSE {_PHONE} END"
_ADDR = _squeeze(r"regexp_replace(lower(address), '[^a-z0-9\s]', '', 'g')")

SQL = {
    "strip_honorifics": rf"""SELECT mention_id, trim(regexp_replace(regexp_replace(regexp_replace({_squeeze('lower(raw_name)')}, '^(?:(?:{_TITLES})[ .]+)+', ''),
        '(?:[ ,.]+(?:{_TITLES})\.?)+$', ''), '^(?:{_TITLES})\.?$', '')) AS name FROM mentions WHERE entity_type = 'judge'""",
    "strip_corp_suffix": f"SELECT mention_id, {_STRIP_CORP.format('raw_name')} AS name FROM mentions WHERE entity_type <> 'judge'",
    "corp_core": f"SELECT mention_id, array_to_string(string_split({_STRIP_CORP.format(_squeeze(chr(39).join(['regexp_replace(lower(raw_name), ', '[-–—]', ', ', ' ', ', ', 'g', ')'])))}, ' ')[1:4], ' ') AS core FROM mentions WHERE entity_type <> 'judge'",
    "name_tokens": f"""SELECT mention_id, CAST(len({_tokens('normalized_name')}) AS INTEGER) AS n_tokens, array_to_string(list_transform({_tokens('normalized_name')}, lambda t: substr(t, 1, 1)), '|') AS initials,
        {_CORE}[-1] AS last_name FROM mentions WHERE normalized_name IS NOT NULL""",
    "surname_keys": f"""WITH s AS (SELECT mention_id, {_CORE}[-1] AS l FROM mentions WHERE entity_type <> 'firm' AND normalized_name IS NOT NULL)
        SELECT mention_id, CASE WHEN l IS NULL THEN '' WHEN contains(l, '-') THEN array_to_string(list_prepend(l, list_filter(list_filter(string_split(l, '-'), lambda p: length(p) >= 2), lambda p, i: list_position(list_filter(string_split(l, '-'), lambda q: length(q) >= 2), p) = i)), ',') ELSE l END AS keys FROM s""",
    "presentable_name": r"""SELECT mention_id, array_to_string(list_transform(regexp_extract_all(raw_name, '([\p{L}\p{M}]+|[^\p{L}\p{M}]+)', 1), lambda r: concat(upper(substr(r, 1, 1)), lower(substr(r, 2)))), '') AS name FROM mentions""",
    "punct_fold_keys": f"SELECT mention_id, concat('tok:', array_to_string({_FOLD}, ' '), CASE WHEN length(array_to_string({_FOLD}, '')) >= 6 THEN concat(',join:', array_to_string({_FOLD}, '')) ELSE '' END) AS keys FROM mentions WHERE normalized_name IS NOT NULL",
    "name_core": f"SELECT mention_id, {_STRIP_CORP.format(chr(39).join(['regexp_replace(' + _NAME_CORE + ', ', chr(92) + 'bmfg' + chr(92) + 'b', ', ', 'manufacturing', ', ', 'g', ')']))} AS core FROM mentions WHERE entity_type <> 'judge'",
    "legal_form": f"SELECT mention_id, {_form_case()} AS form FROM mentions WHERE entity_type <> 'judge'",
    "classify_office": f"SELECT mention_id, {_class_case()} AS office_class FROM mentions WHERE entity_type <> 'judge'",
    "email_domain": "SELECT mention_id, CASE WHEN contains(email, '@') THEN nullif(trim(lower(string_split(email, '@')[-1])), '') END AS email_domain FROM mentions",
    "contact_norm": rf"""SELECT mention_id, CASE WHEN length({_PHONE11}) >= 7 THEN {_PHONE11} END AS phone_key, nullif(trim(regexp_replace(lower(trim(domain)), '^www\.', '')), '') AS domain_key,
        CASE WHEN length({_ADDR}) >= 8 THEN {_ADDR} END AS address_key FROM mentions""",
    "iso_dates": """SELECT mention_id, coalesce(strftime(try_strptime(trim(filing_date), '%m/%d/%Y'), '%Y-%m-%d'), strftime(try_strptime(trim(filing_date), '%Y-%m-%d'), '%Y-%m-%d')) AS filed_on, TRY_CAST(nullif(regexp_extract(filing_date, '((?:19|20)[0-9]{2})', 1), '') AS INTEGER) AS filed_year FROM mentions""",
    "office_geo": f"""WITH l AS (SELECT mention_id, list_filter(list_transform(list_reverse(string_split(address, chr(10))), lambda s: regexp_extract(s, '{_GEO}', 0)), lambda s: s <> '')[1] AS line FROM mentions WHERE address IS NOT NULL)
        SELECT mention_id, CASE WHEN line IS NOT NULL THEN concat(lower(regexp_extract(line, '{_GEO}', 1)), '|', regexp_extract(line, '{_GEO}', 2)) END AS geo FROM l""",
    "mention_ids": """SELECT mention_id, concat('mnt_', substr(sha1(array_to_string([coalesce(ucid, ''), coalesce(docket_source, ''), coalesce(raw_name, ''), coalesce(CAST(party_enum AS VARCHAR), ''), coalesce(CAST(judge_enum AS VARCHAR), ''),
        coalesce(CAST(docket_index AS VARCHAR), ''), coalesce(role, ''), coalesce(CAST(counsel_enum AS VARCHAR), '')], '|')), 1, 16)) AS key FROM mentions""",
    "profile_text": "SELECT mention_id, concat_ws(' | ', nullif(trim(presentable_name), ''), nullif(trim(court), ''), nullif(trim(role), ''), nullif(trim(office_name), ''), nullif(trim(domain), '')) AS profile FROM mentions",
}
