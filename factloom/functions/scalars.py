"""Scalar rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Schemes, namespaces and forms of the filing model.
SEC_SCHEME = "http://www.sec.gov/CIK"
ISO4217 = "http://www.xbrl.org/2003/iso4217"
ANNUAL_FORMS = ("10-K", "10-K/A")
FAMILY_PREFIXES = {
    "us-gaap": ("http://fasb.org/us-gaap/", "http://xbrl.us/us-gaap/", "https://fasb.org/us-gaap/", "https://xbrl.us/us-gaap/"),
    "dei": ("http://xbrl.sec.gov/dei/", "http://xbrl.us/dei/", "https://xbrl.sec.gov/dei/", "https://xbrl.us/dei/"),
    "srt": ("http://fasb.org/srt/", "https://fasb.org/srt/"),
}
STANDARD_HOSTS = ("xbrl.sec.gov", "fasb.org", "xbrl.us")


def is_valid_cik(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[0-9]{1,10}$"), F.lit(False))


def normalize_cik(c: Column) -> Column:
    return F.when(is_valid_cik(c), F.lpad(c, 10, "0"))


def is_valid_accession(a: Column) -> Column:
    return F.coalesce(a.rlike(r"^\d{10}-\d{2}-\d{6}$"), F.lit(False))


def accession_to_cik(a: Column) -> Column:
    return F.when(is_valid_accession(a), F.substring(a, 1, 10))


def accession_dashless(a: Column) -> Column:
    return F.when(is_valid_accession(a), F.replace(a, F.lit("-"), F.lit("")))


def clark_name(ns: Column, local: Column) -> Column:
    return F.concat(F.lit("{"), ns, F.lit("}"), local)


def concept_key(ns: Column, local: Column) -> Column:
    return F.sha2(clark_name(ns, local), 256)


def url_host(u: Column) -> Column:
    return F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)


def namespace_family(ns: Column) -> Column:
    out = F.lit("other")
    for family, prefixes in FAMILY_PREFIXES.items():
        for p in prefixes:
            out = F.when(ns.startswith(p), F.lit(family)).otherwise(out)
    return out


def is_standard_host(ns: Column) -> Column:
    """An http or https address at one of the standard hosts, whatever its case, user and port."""
    hosts = "|".join(h.replace(".", "[.]") for h in STANDARD_HOSTS)
    return F.coalesce(ns.rlike(rf"^(?i:https?)://(?:[^/?#@]*@)?+(?i:{hosts})(?:[/?#:]|\z)"), F.lit(False))


def namespace_origin(ns: Column) -> Column:
    known = F.coalesce(namespace_family(ns) != "other", F.lit(False))
    return F.when(known | is_standard_host(ns), "standard").otherwise("issuer")


def release_token(ns: Column) -> Column:
    """Last path segment of the namespace."""
    return F.element_at(F.split(F.rtrim(ns, F.lit("/")), "/"), -1)


def taxonomy_year(ns: Column) -> Column:
    year = F.regexp_extract(ns, r"/((?:19|20)\d{2})(?:-\d{2}-\d{2})?/?$", 1)
    return F.when(year != "", year.cast("int"))


def whole_places(d: Column) -> Column:
    """Places as a whole number, else null. INF is told beforehand: Spark's try_cast raises and catches an exception for each text that is no number."""
    return F.when(F.upper(d) != "INF", d).try_cast("int")


def parse_decimals(d: Column) -> Column:
    """Struct(rank, digits): 0 for INF in either case, 1 for a whole number, 2 for neither."""
    n = whole_places(d)
    return F.struct(F.when(F.upper(d) == "INF", 0).when(n.isNotNull(), 1).otherwise(2).alias("rank"), n.alias("digits"))


def half_width(d: Column) -> Column:
    """Half a unit of the last reported place; 0 for INF and null. Places whose half unit a decimal(28,10) cannot hold exactly, beyond -18 to 9, are refused."""
    n = whole_places(d)
    digits = F.when(n < 0, F.concat(F.lit("5"), F.repeat(F.lit("0"), -n - 1))).otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), n), F.lit("5")))
    wide = F.raise_error(F.concat(F.lit("decimals out of range: "), d)).cast("decimal(28,10)")
    return F.when(n.isNull(), F.lit("0").cast("decimal(28,10)")).when(n.between(-18, 9), digits.try_cast("decimal(28,10)")).otherwise(wide)


def fact_lo(v: Column, d: Column) -> Column:
    return v - half_width(d)


def fact_hi(v: Column, d: Column) -> Column:
    return v + half_width(d)


def interval_contains(lo: Column, hi: Column, period: Column) -> Column:
    """Both ends open: always; a null period fits only that; bounds are inclusive."""
    free = lo.isNull() & hi.isNull()
    return F.coalesce(free | ((lo.isNull() | (lo <= period)) & (hi.isNull() | (period <= hi)) & period.isNotNull()), F.lit(False))


def intervals_overlap(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    return F.coalesce(lo1 <= hi2, F.lit(True)) & F.coalesce(lo2 <= hi1, F.lit(True))


def scopes_overlap(kind1: Column, cik1: Column, kind2: Column, cik2: Column) -> Column:
    return ~((kind1 == "issuer") & (kind2 == "issuer") & (cik1 != cik2))


def normalize_whitespace(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"[\s   ]+", " "))


def offset_aware_timestamp(t: Column) -> Column:
    return F.when(t.rlike(r"(Z|[+-]\d{2}:\d{2})$"), t.try_cast("timestamp"))


def sanitize_basename(n: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(n, "/"), -1), r"[^A-Za-z0-9._-]", "_")


def is_safe_logical_path(p: Column) -> Column:
    return F.coalesce((p != "") & ~p.startswith("/") & ~p.rlike(r"(^|/)\.\.?(/|$)") & ~p.contains("\\") & ~p.contains("//"), F.lit(False))


def item_token(t: Column) -> Column:
    return F.upper(F.regexp_extract(t, r"(?i)^\s*item\s+(\d{1,2}[a-c]?)\b", 1))


def default_part_for_item(item: Column) -> Column:
    """Annual form: items 1 to 4, 5 to 9, 10 to 14 and 15 to 16."""
    n = F.regexp_extract(item, r"^\d+", 0).try_cast("int")
    return F.when(n.between(1, 4), 1).when(n.between(5, 9), 2).when(n.between(10, 14), 3).when(n.between(15, 16), 4)


#: The fields of a metric's definition in the order of their canonical JSON, and those that are lists.
DEFINITION_FIELDS = ("definition", "excludes", "includes", "key", "kind", "period_type", "statement", "unit_dimension", "value_kind")
LIST_FIELDS = ("excludes", "includes")


def _canonical(fields: tuple[str, ...]) -> Column:
    return F.to_json(F.struct(*[(F.sort_array(f) if f in LIST_FIELDS else F.col(f)).alias(f) for f in fields]), {"ignoreNullFields": "false"})


def definition_hash() -> Column:
    """SHA-256 of a metric's canonical JSON: sorted keys and lists, without its name."""
    return F.sha2(_canonical(DEFINITION_FIELDS), 256)


def duplicate_signature() -> Column:
    """As definition_hash, without the key: equal for two metrics of one meaning."""
    return F.sha2(_canonical(tuple(f for f in DEFINITION_FIELDS if f != "key")), 256)


def report_key(accession: Column, kind: Column, paths: Column) -> Column:
    """SHA-256 of the canonical JSON of a report's inputs; paths is an array, in any order."""
    return F.sha2(F.to_json(F.struct(accession.alias("accession"), F.sort_array(paths).alias("inputs"), kind.alias("kind"))), 256)


def parse_acceptance(t: Column) -> Column:
    """Fourteen digits, in UTC, or an ISO time, in UTC unless it names an offset; null for anything else."""
    digits = F.when(t.rlike(r"^[0-9]{14}$"), F.try_to_timestamp(F.concat(t, F.lit(" +0000")), F.lit("yyyyMMddHHmmss Z")))
    iso = F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"), t)
    zoned = F.when(iso.rlike(r"(Z|[+-][0-9]{2}:[0-9]{2})$"), iso).otherwise(F.concat(F.when(iso.rlike("[T ]"), iso).otherwise(F.concat(iso, F.lit("T00:00:00"))), F.lit("Z")))
    return F.coalesce(digits, zoned.try_cast("timestamp"))


def part_number(t: Column) -> Column:
    """1 to 4 of a roman numeral, in either case; else null."""
    return F.create_map(*[F.lit(x) for kv in {"I": 1, "II": 2, "III": 3, "IV": 4}.items() for x in kv])[F.upper(F.trim(t))]


def resolved_kind_ok(kind: Column, numeric: Column, text: Column) -> Column:
    """Whether the columns that hold a value are those of its kind."""
    want = F.when(kind == "numeric", numeric.isNotNull() & text.isNull()).when(kind == "text", numeric.isNull() & text.isNotNull()).when(kind == "none", numeric.isNull() & text.isNull())
    return F.coalesce(want, F.lit(False))


#: What a URI may hold unescaped, and ports that a scheme implies.
UNRESERVED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~"
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21"}


def normalize_uri(u: Column) -> Column:
    """Scheme and host in lower case, no default port and no fragment, escapes in upper case and only where needed, no dot segments; an empty query stays. Null for what is no absolute
    hierarchical URI or holds a broken escape."""
    u = F.regexp_replace(u, "#.*$", "")
    part = lambda n: F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\?.*)?$", n)
    scheme, authority = F.lower(part(1)), part(2)
    user, host, port = (F.regexp_extract(authority, r"^([^@]*@)?(.*?)(?::([0-9]*))?$", n) for n in (1, 2, 3))
    plain_port = (port == "") | F.coalesce(F.create_map(*[F.lit(x) for kv in DEFAULT_PORTS.items() for x in kv])[scheme] == port, F.lit(False))
    netloc = F.concat(user, F.lower(host), F.when(plain_port, "").otherwise(F.concat(F.lit(":"), port)))
    broken = u.rlike(r"%(?![0-9A-Fa-f]{2})") | u.rlike(r"[\x00-\x20\x7F]") | (scheme == "") | (host == "")
    return F.when(~broken, F.concat(scheme, F.lit("://"), netloc, _without_dots(_escapes(part(3))), _escapes(part(4))))


def _escapes(t: Column) -> Column:
    """Each %XX in upper case, or its character where that needs no escape."""
    bits = F.regexp_extract_all(t, F.lit(r"(%[0-9A-Fa-f]{2}|[^%]+)"), 1)
    char = lambda b: F.char(F.conv(F.substring(b, 2, 2), 16, 10).cast("int"))
    free = lambda b: F.conv(F.substring(b, 2, 2), 16, 10).cast("int").isin(*[ord(c) for c in UNRESERVED])
    return F.array_join(F.transform(bits, lambda b: F.when(~b.startswith("%"), b).when(free(b), char(b)).otherwise(F.upper(b))), "")


def _without_dots(path: Column) -> Column:
    """Segments in order; '.' goes and '..' takes the one before it along. An empty path is '/'."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    keep = F.aggregate(parts, F.array().cast("array<string>"), lambda s, x: F.when(x == ".", s).when(x == "..", F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(F.concat(s, F.array(x))))
    last = F.element_at(parts, -1)
    return F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.concat(keep, F.array(F.lit("")))).otherwise(keep), "/"))
