"""Scalar rules as native column expressions: dates, addresses, digests, links, responses, cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/New_York"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time -------------------------------------------------------------------


def to_second(ts: str | Column) -> Column:
    """A timestamp without zone, cut to whole seconds; stays without zone."""
    second = F.date_part(F.lit("SECOND"), _col(ts))
    return _col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second - F.floor(second))


def local_time(utc: str | Column, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(utc))


def local_date(utc: str | Column, zone: str = ZONE) -> Column:
    return F.to_date(local_time(utc, zone))


def slot_utc(utc: str | Column, hour: int, minute: int, zone: str = ZONE) -> Column:
    """The slot of an instant: the configured wall time on its local date, as UTC."""
    wall = local_date(utc, zone).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(hour), F.lit(minute), F.lit(0))
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def utc_text(ts: str | Column) -> Column:
    return F.concat(F.regexp_replace(to_second(ts).cast("string"), " ", "T"), F.lit("Z"))


def duration_text(start: str | Column, end: str | Column) -> Column:
    """"1h 2m 3s" with leading zero units left out; null if either end is missing; a negative span counts as zero."""
    s = F.greatest(F.timestamp_diff("SECOND", _col(start), _col(end)), F.lit(0))
    h, m, r = (s / 3600).cast("long"), (s % 3600 / 60).cast("long"), s % 60
    return F.when(s >= 3600, F.format_string("%dh %dm %ds", h, m, r)).when(s >= 60, F.format_string("%dm %ds", m, r)).when(s.isNotNull(), F.format_string("%ds", r))


# The ways in which dates are displayed.
MONTH_DAY_MINUTE = r"^([A-Za-z]{3,9})\s+(\d{1,2})\s+(\d{4})\s+(\d{1,2}):(\d{2})\s*([AaPp][Mm])$"
MONTH_DAY = r"^([A-Za-z]{3,9})\s+(\d{1,2})\s+(\d{4})$"
ISO_DAY = r"^(\d{4})-(\d{2})-(\d{2})$"
# Grouped by day, time and offset, which are read apart.
MACHINE = r"^(\d{4}-\d{2}-\d{2})[Tt ](\d{2}:\d{2}(?::\d{2})?)(?:\.\d+)?([Zz]|[+-]\d{2}:?\d{2})?$"


def squeezed(text: str | Column) -> Column:
    """White space of any kind, no-break spaces too, as single spaces, and none at the ends."""
    return F.trim(F.regexp_replace(_col(text), r"(?U)[\s\x1c-\x1f]+", " "))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _month_first(d: Column) -> Column:
    return F.regexp_replace(d, r"^(\d{1,2}) ([A-Za-z]{3,9}) ", "$2 $1 ")


def _precision(d: Column) -> Column:
    """Of a squeezed date, its month first."""
    return F.when(d.rlike(MONTH_DAY_MINUTE), "minute").when(d.rlike(MONTH_DAY) | d.rlike(ISO_DAY), "date").otherwise("unknown")


def display_precision(display: str | Column) -> Column:
    return _once(_month_first(squeezed(display)), _precision)


def _displayed(d: Column, precision: Column) -> Column:
    """The wall time of a squeezed date, its month first; null where the pattern fits and the date is none (full month names, day 31 of a short month)."""
    minute = F.try_to_timestamp(F.regexp_replace(d, r" ?([AaPp][Mm])$", " $1"), F.lit("MMM d yyyy h:mm a"))
    day = F.when(F.substring(d, 5, 1) == "-", F.try_to_timestamp(d, F.lit("yyyy-MM-dd"))).otherwise(F.try_to_timestamp(d, F.lit("MMM d yyyy")))
    return F.when(precision == "minute", minute).when(precision == "date", day).cast("timestamp_ntz")


def machine_instant(machine: str | Column) -> Column:
    """UTC instant (without zone) of an ISO timestamp; no offset means UTC; null if it is none."""

    def read(m: Column) -> Column:
        zone = F.regexp_extract(m, MACHINE, 3)
        local = F.try_to_timestamp(F.concat_ws(" ", F.regexp_extract(m, MACHINE, 1), F.rpad(F.regexp_extract(m, MACHINE, 2), 8, ":00")), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
        sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
        digits = F.regexp_replace(zone, "[^0-9]", "")
        shift = F.when(digits == "", 0).otherwise(sign * (F.substring(digits, 1, 2).cast("int") * 60 + F.substring(digits, 3, 2).cast("int")))
        return F.when(m.rlike(MACHINE), local - F.make_dt_interval(F.lit(0), F.lit(0), shift, F.lit(0)))

    return _once(squeezed(machine), read)


def source_date(display: str | Column, machine: str | Column, zone: str = ZONE) -> Column:
    """struct(state, precision, utc, local_date) of an advertised date: what is displayed, and a machine-readable value beside it."""
    texts = F.struct(_month_first(squeezed(display)).alias("shown"), F.nullif(squeezed(machine), F.lit("")).alias("other"))

    def parts(t: Column) -> Column:
        return _once(F.struct(t["shown"].alias("shown"), t["other"].alias("other"), _precision(t["shown"]).alias("precision"), F.when(t["other"].isNotNull(), machine_instant(t["other"])).alias("instant")), dated)

    def dated(p: Column) -> Column:
        read = _displayed(p["shown"], p["precision"])
        return _once(F.struct(*(p[n].alias(n) for n in ("shown", "other", "precision", "instant")), read.alias("read")), judged)

    def judged(p: Column) -> Column:
        known, read, instant = p["precision"] != "unknown", p["read"], p["instant"]
        state = (
            F.when((p["shown"].isNull() & p["other"].isNull()) | (p["shown"] == ""), "absent")
            .when(instant.isNotNull(), F.when(F.coalesce(known, F.lit(False)), "parsed").otherwise("unparsed"))
            .when(known, F.when(read.isNull(), "invalid").otherwise("parsed"))
            .when(p["other"].isNotNull(), "invalid")
            .otherwise("unparsed")
        )

        def result(s: Column) -> Column:
            parsed = s == "parsed"
            utc = F.when(parsed, F.coalesce(instant, F.when(p["precision"] == "minute", F.convert_timezone(F.lit(zone), F.lit("UTC"), read))))
            date = F.when(parsed, F.coalesce(local_date(instant, zone), F.to_date(read)))
            kept = F.when(s == "absent", "unknown").otherwise(p["precision"])
            return F.struct(s.alias("state"), kept.alias("precision"), utc.alias("utc"), date.alias("local_date"))

        return _once(state, result)

    return _once(texts, parts)


# -- digests ----------------------------------------------------------------


def digest(*parts: str | Column) -> Column:
    """SHA-256 over the parts, each followed by the unit separator; null counts as empty."""
    return F.sha2(F.concat(*(x for p in parts for x in (F.coalesce(_col(p).cast("string"), F.lit("")), F.lit("\x1f")))), 256)


def lineage(parser: Column, contract: Column, text_contract: Column) -> Column:
    return F.concat_ws("|", parser, contract, text_contract)


def text_fingerprint(text: str | Column, text_contract: str) -> Column:
    return digest(F.lit("text"), F.lit(text_contract), text)


def html_fingerprint(markup: str | Column, contract: str) -> Column:
    return digest(F.lit("html"), F.lit(contract), markup)


def metadata_fingerprint(values: str | Column, contract: str) -> Column:
    """``values``: array of field_key, field_state, ordinal, origin, source_label, value_text in source order; verbatim parts only, nulls kept."""
    names = ("field_key", "field_state", "ordinal", "origin", "source_label", "value_text")
    rows = F.transform(_col(values), lambda v: F.struct(*(v[n].alias(n) for n in names)))
    return digest(F.lit("metadata"), F.lit(contract), F.to_json(rows, {"ignoreNullFields": "false"}))


def content_fingerprint(of_lineage: Column, title: Column, *shares: Column) -> Column:
    return digest(F.lit("content"), of_lineage, title, *shares)


def page_signature(ids: Column, next_url: Column) -> Column:
    return F.sha2(F.concat(F.array_join(ids, ","), F.lit("|"), F.coalesce(next_url, F.lit(""))), 256)


# -- addresses --------------------------------------------------------------


def page_url(base: str | Column, page: str | Column, items: int) -> Column:
    """Address of a listing page; the first page without a query is the base itself, any other query is replaced."""
    path = F.regexp_extract(_col(base), r"^[^?#]*", 0)
    bare = (_col(page) <= 1) & ~F.contains(_col(base), F.lit("?"))
    return F.when(bare, _col(base)).otherwise(F.concat(path, F.format_string("?page=%d&page-items=%d", _col(page).cast("int"), F.lit(items))))


def host_of(url: str | Column) -> Column:
    return F.lower(F.try_parse_url(_col(url), F.lit("HOST")))


def origin_of(url: str | Column) -> Column:
    scheme = F.lower(F.try_parse_url(_col(url), F.lit("PROTOCOL")))
    port = F.regexp_extract(_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^/?#:]*):(\d+)", 1)
    known = F.when(port != "", port).when(scheme == "https", "443").when(scheme == "http", "80").otherwise("")
    return F.concat_ws("|", scheme, host_of(url), known)


def same_origin(a: str | Column, b: str | Column) -> Column:
    return origin_of(a) == origin_of(b)


def allowed_url(url: str | Column, hosts: list[str]) -> Column:
    """https or http to one of the hosts or below it, without user information; false for what is no address."""
    host = host_of(url)
    below = F.lit(False)
    for h in hosts:
        below = below | (host == h) | host.endswith(f".{h}")
    scheme = F.lower(F.try_parse_url(_col(url), F.lit("PROTOCOL")))
    return F.coalesce(scheme.isin("http", "https") & below & F.try_parse_url(_col(url), F.lit("USERINFO")).isNull(), F.lit(False))


def public_ipv4(ip: str | Column) -> Column:
    """Whether a dotted address is public; null if it is none."""
    o = [F.regexp_extract(_col(ip), r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$", k).try_cast("int") for k in (1, 2, 3, 4)]
    ok = o[0].isNotNull() & (o[0] <= 255) & (o[1] <= 255) & (o[2] <= 255) & (o[3] <= 255)
    private = o[0].isin(0, 10, 127) | (o[0] >= 224) | ((o[0] == 172) & o[1].between(16, 31)) | ((o[0] == 192) & (o[1] == 168)) | ((o[0] == 169) & (o[1] == 254)) | ((o[0] == 100) & o[1].between(64, 127))
    return F.when(ok, ~private)


def job_id_of(url: str | Column) -> Column:
    return F.nullif(F.regexp_extract(F.try_parse_url(_col(url), F.lit("PATH")), r"^/[a-z]{2}-[a-z]{2}/job/(\d+)", 1), F.lit(""))


# The suffixes of attached documents, and the classes of links into the application workflow.
DOCUMENT_SUFFIXES = ("pdf", "doc", "docx", "rtf", "odt", "xls", "xlsx", "csv", "txt", "ppt", "pptx")
APPLY_PATH, REFERRAL = "/apply/", "employee-referral"
APPLY_CLASSES = ("apply-link", "employee-referral-link")


def link_class(url: str | Column, own_domain: str, career_host: str, vendor_host: str | None = None, css_class: str | Column | None = None, documents: bool = True) -> Column:
    """struct(class, decision, reason) of a resolved link by the first rule that fits; only documents of the own domain are fetched.

    Each rule is its class, its decision, why a link is left, and when it holds. A listing's links (``documents`` false) are no documents of a job.
    """
    u = F.lower(_col(url))
    host, path = F.coalesce(host_of(url), F.lit("")), F.lower(F.coalesce(F.try_parse_url(_col(url), F.lit("PATH")), F.lit("")))
    no = F.lit(False)
    marked = no if css_class is None else F.coalesce(F.arrays_overlap(F.split(_col(css_class), r"\s+"), F.array(*map(F.lit, APPLY_CLASSES))), no)
    applying = marked | F.contains(u, F.lit(APPLY_PATH)) | (no if vendor_host is None else F.contains(host, F.lit(vendor_host)))
    document = path.rlike(rf"\.({'|'.join(DOCUMENT_SUFFIXES)})$") if documents else no
    rules = (
        ("mailto", "exclude", "address_of_mail", u.startswith("mailto:")),
        ("anchor", "exclude", "within_the_page", u.startswith("#") | u.startswith("javascript:")),
        ("apply_workflow", "exclude", "application", applying if documents else applying | F.contains(u, F.lit(REFERRAL))),
        ("job_document", "fetch", None, document & ((host == own_domain) | host.endswith(f".{own_domain}"))),
        ("job_document", "exclude", "document_of_another_host", document),
        ("internal_nav", "exclude", "way_around_the_board", host.endswith(career_host)),
        ("external", "exclude", "another_site", F.lit(True)),
    )
    found = F.lit(None)
    for kind, decision, reason, holds in reversed(rules):
        found = F.when(holds, F.struct(F.lit(kind).alias("class"), F.lit(decision).alias("decision"), F.lit(reason).cast("string").alias("reason"))).otherwise(found)
    return found


def redirect_class(requested: str | Column, final: str | Column, hops: str | Column) -> Column:
    r, f = _col(requested), _col(final)
    return (
        F.when(f.isNull() | (_col(hops) == 0) | (r == f), "none")
        .when(F.contains(F.coalesce(F.try_parse_url(f, F.lit("PATH")), F.lit("")), F.lit("/listing")), "to_listing")
        .when(job_id_of(r) != job_id_of(f), "to_other_job")
        .when(job_id_of(r) == job_id_of(f), "same_job_canonicalised")
        .otherwise("to_other")
    )


# -- responses --------------------------------------------------------------


def access_control(status: str | Column, headers: str | Column, body: str | Column) -> Column:
    """Signal of an access-control response; null for ordinary ones. ``headers``: map with lower-case names."""
    s, h = _col(status), _col(headers)
    action = F.coalesce(*(F.nullif(F.try_element_at(h, F.lit(n)), F.lit("")) for n in ("x-amzn-waf-action", "x-amz-waf-action")))
    head = F.lower(F.substring(_col(body), 1, 4096))
    return (
        F.when(action.isNotNull(), F.concat(F.lit("aws-waf-"), F.lower(action)))
        .when(s == 429, "rate-limited")
        .when((s == 503) & F.contains(head, F.lit("cf-browser-verification")), "cf-challenge")
        .when((s == 403) & F.contains(head, F.lit("captcha")), "captcha")
    )


def retryable(status: str | Column, state: str | Column, signal: str | Column) -> Column:
    return F.coalesce(_col(signal).isNull() & ((_col(state) != "complete") | _col(status).isin(408, 425, 429) | (_col(status) >= 500)), F.lit(False))


def fetch_ok(status: str | Column, state: str | Column, signal: str | Column) -> Column:
    return F.coalesce((_col(state) == "complete") & (_col(status) == 200) & _col(signal).isNull(), F.lit(False))


def capped(body: str | Column, cap: int) -> Column:
    """struct(state, body): at most ``cap`` bytes are kept, and a longer body is said to be partial."""
    return F.struct(F.when(F.length(_col(body)) > cap, "partial").otherwise("complete").alias("state"), F.substring(_col(body), 1, cap).alias("body"))


# Headers whose values are never kept.
SECRET_HEADERS = ("authorization", "proxy-authorization", "cookie", "set-cookie", "x-api-key", "x-amz-security-token")


def clean_headers(pairs: str | Column) -> Column:
    """Map of lower-case names to values from an array of (name, value): repeated ones joined, secret ones redacted."""
    names = F.array_distinct(F.transform(_col(pairs), lambda p: F.lower(p["name"])))
    value = lambda n: F.when(n.isin(*SECRET_HEADERS), "<redacted>").otherwise(F.array_join(F.transform(F.filter(_col(pairs), lambda p: F.lower(p["name"]) == n), lambda p: p["value"]), ", "))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n, value(n))))


def media_type(content_type: str | Column) -> Column:
    c = _col(content_type)
    charset = F.lower(F.regexp_extract(c, r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", 1))
    return F.struct(F.nullif(F.lower(F.trim(F.split_part(c, F.lit(";"), F.lit(1)))), F.lit("")).alias("type"), F.nullif(charset, F.lit("")).alias("charset"))


# -- cells and text ---------------------------------------------------------


def spreadsheet_safe(value: str | Column) -> Column:
    """A leading quote for cells that a spreadsheet would run."""
    return F.when(_col(value).rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), _col(value))).otherwise(_col(value))


def label_key(label: str | Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(F.btrim(_col(label))), r"[^a-z0-9]+", "_"), F.lit("_"))


def multi_values(value: str | Column) -> Column:
    return F.filter(F.split(_col(value), r"[ \t\r\n]*;[ \t\r\n]*"), lambda v: F.btrim(v) != "")


def html_escape(value: str | Column) -> Column:
    out = _col(value)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def mib(n: str | Column) -> Column:
    return F.format_string("%.1f MiB", _col(n) / F.lit(1048576.0))


# The release that has the fix, and the releases that brought it to older series.
FIXED_IN = (3, 51, 3)
BACKPORTS = ((3, 44, 6), (3, 50, 7))


def version_at_least(version: str | Column, least: tuple[int, int, int] = FIXED_IN, backports: tuple[tuple[int, int, int], ...] = BACKPORTS) -> Column:
    """Whether a release is ``least`` or later, or within the series of a backport and not before it; missing numbers count as zero."""
    number = lambda k: F.coalesce(F.get(F.split(_col(version), r"\."), F.lit(k)).try_cast("int"), F.lit(0))
    own = F.struct(*(number(k).alias(f"n{k}") for k in range(3)))
    release = lambda v: F.struct(*(F.lit(n).alias(f"n{k}") for k, n in enumerate(v)))
    out = own >= release(least)
    for major, minor, patch in backports:
        out = out | ((own["n0"] == major) & (own["n1"] == minor) & (own["n2"] >= patch))
    return F.when(_col(version).isNotNull(), out)
