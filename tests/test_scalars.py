from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import markup as M
from tidemark.functions.tape import slice_by_id
from tidemark.functions import scalars as S


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("display", "machine", "state", "precision", "utc", "day"),
    [
        ("Mar 03 2027 ", "2027-03-03T12:00:00Z", "parsed", "date", "2027-03-03 12:00:00", "2027-03-03"),
        ("Mar 30 2027 11:40 PM", "2027-03-31T03:40:00Z", "parsed", "minute", "2027-03-31 03:40:00", "2027-03-30"),
        ("Mar 03 2027", None, "parsed", "date", None, "2027-03-03"),
        ("Mar 30 2027 11:40 PM", None, "parsed", "minute", "2027-03-31 03:40:00", "2027-03-30"),
        (None, None, "absent", "unknown", None, None),
        ("   ", "2027-03-03T12:00:00Z", "absent", "unknown", None, None),
        ("Feb 30 2027", None, "invalid", "date", None, None),
        ("March 3 2027", None, "invalid", "date", None, None),
        ("When somebody is found", None, "unparsed", "unknown", None, None),
        ("When somebody is found", "2027-03-03T12:00:00Z", "unparsed", "unknown", None, None),
        (None, "one day", "invalid", "unknown", None, None),
        ("Mar 03 2027", "2027-14-41T00:00:00Z", "parsed", "date", None, "2027-03-03"),
        ("Mar 03 2027 03:00 PM", "2027-03-03T15:00:00+03:00", "parsed", "minute", "2027-03-03 12:00:00", "2027-03-03"),
        ("3 Mar 2027", None, "parsed", "date", None, "2027-03-03"),
        ("Oct\u00a003 2026", None, "parsed", "date", None, "2026-10-03"),
        ("\tNov 4 2026\n", None, "parsed", "date", None, "2026-11-04"),
        ("4\u2003nov 2026 1:05 am", None, "parsed", "minute", "2026-11-04 06:05:00", "2026-11-04"),
        ("2026-12-05", "\u00a02026-12-05T10:00:00Z", "parsed", "date", "2026-12-05 10:00:00", "2026-12-05"),
        ("mar 30 2027  11:40pm", None, "parsed", "minute", "2027-03-31 03:40:00", "2027-03-30"),
    ],
)
def test_source_dates(spark, display, machine, state, precision, utc, day):
    d = one(spark, S.source_date(F.lit(display).cast("string"), F.lit(machine).cast("string")))
    assert (d["state"], d["precision"], str(d["utc"]) if d["utc"] else None, str(d["local_date"]) if d["local_date"] else None) == (state, precision, utc, day)


@pytest.mark.parametrize(("cell", "safe"), [("=SUM(A1)", "'=SUM(A1)"), ("+1", "'+1"), ("-x", "'-x"), ("@i", "'@i"), ("\tt", "'\tt"), ("plain", "plain"), ("", ""), (None, None)])
def test_spreadsheet_cells(spark, cell, safe):
    assert one(spark, S.spreadsheet_safe(F.lit(cell).cast("string"))) == safe


@pytest.mark.parametrize(
    ("status", "headers", "body", "signal"),
    [
        (202, {"x-amzn-waf-action": "challenge"}, "", "aws-waf-challenge"), (403, {"x-amzn-waf-action": "block"}, "", "aws-waf-block"), (429, {"a": "b"}, "", "rate-limited"),
        (503, {"a": "b"}, "cf-browser-verification", "cf-challenge"), (403, {"a": "b"}, "a CAPTCHA", "captcha"), (200, {"a": "b"}, "captcha", None), (404, {"a": "b"}, "", None),
    ],
)
def test_access_control(spark, status, headers, body, signal):
    h = F.create_map(*(F.lit(x) for kv in headers.items() for x in kv))
    assert one(spark, S.access_control(F.lit(status), h, F.lit(body))) == signal


@pytest.mark.parametrize(
    ("url", "css", "expected"),
    [
        ("mailto:a@b.c", "", ("mailto", "exclude")), ("javascript:x()", "", ("anchor", "exclude")), ("https://x.example.com/p", "btn apply-link", ("apply_workflow", "exclude")),
        ("https://jobs.example.com/apply/1", "", ("apply_workflow", "exclude")), ("https://a.example.com/x.PDF", "", ("job_document", "fetch")), ("https://other.org/x.pdf", "", ("job_document", "exclude")),
        ("https://vendor.net/x.pdf", "", ("apply_workflow", "exclude")), ("https://jobs.example.com/listing", "", ("internal_nav", "exclude")), ("https://www.example.com/", "", ("external", "exclude")),
    ],
)
def test_links(spark, url, css, expected):
    assert tuple(one(spark, S.link_class(F.lit(url), "example.com", "jobs.example.com", "vendor.net", F.lit(css))))[:2] == expected


def test_digest_ends_every_part(spark):
    import hashlib

    assert one(spark, S.digest(F.lit("a"), F.lit(None))) == hashlib.sha256(b"a\x1f\x1f").hexdigest()


def test_addresses(spark):
    assert one(spark, S.same_origin(F.lit("https://a.b/x"), F.lit("https://A.b:443/y")))
    assert not one(spark, S.same_origin(F.lit("https://a.b/x"), F.lit("http://a.b/x")))
    assert one(spark, S.allowed_url(F.lit("https://x.a.b/"), ["a.b"])) and not one(spark, S.allowed_url(F.lit("ftp://a.b/"), ["a.b"])) and not one(spark, S.allowed_url(F.lit("no address"), ["a.b"]))
    assert one(spark, S.public_ipv4(F.lit("8.8.8.8"))) and not one(spark, S.public_ipv4(F.lit("10.0.0.1"))) and one(spark, S.public_ipv4(F.lit("x"))) is None


def test_headers_and_durations(spark):
    pairs = F.array(*(F.struct(F.lit(a).alias("name"), F.lit(b).alias("value")) for a, b in (("A", "1"), ("a", "2"), ("Set-Cookie", "s"))))
    assert one(spark, S.clean_headers(pairs)) == {"a": "1, 2", "set-cookie": "<redacted>"}
    t = lambda x: F.to_timestamp_ntz(F.lit(x))
    assert one(spark, S.duration_text(t("2024-01-01 00:00:00"), t("2024-01-01 01:02:03"))) == "1h 2m 3s"
    fixed = {v: one(spark, S.version_at_least(F.lit(v).cast("string"))) for v in ("3.51.3", "3.51.2", "3.44.6", "3.44.5", "3.50.7", "3.50.9", "3.45.9", "3.52", "4", "3.9.9", None)}
    assert fixed == {"3.51.3": True, "3.51.2": False, "3.44.6": True, "3.44.5": False, "3.50.7": True, "3.50.9": True, "3.45.9": False, "3.52": True, "4": True, "3.9.9": False, None: None}


@pytest.mark.parametrize(
    ("markup", "text"),
    [
        ("<p>one</p>\n\n\n\n <p> two </p>", "one\n\ntwo"), ("<pre>a  b\n\n\n c</pre>", "a  b\n\n\n c"), ("x&nbsp;y &amp; z", "x\xa0y & z"), ("a<br>b", "a\nb"), ("", ""), (None, ""), ("  ", ""),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\t2\n\n3"), ("<script>no</script>yes<!-- no -->", "yes"), ("<ul><li>a<li>b</ul>", "a\n\nb"), ("<p>a<p>b", "a\n\nb"),
    ],
)
def test_markup_text(markup, text):
    assert M.markup_text(markup) == text


def test_decoding():
    assert M.decode_bytes(b"\xef\xbb\xbfa")["text"] == "a"
    assert M.decode_bytes("é".encode("cp1252"))["encoding"] == "cp1252"
    assert M.decode_bytes(b'<meta charset="iso-8859-1">\xe9', "no-such")["text"].endswith("é")
    assert M.decode_bytes(None)["text"] == ""


def test_slicing():
    assert slice_by_id('<div id="a"><!-- </div> --><div>x</div><p title="</div>">y</p></div><p>', "a").endswith("y</p></div>")
    assert slice_by_id("<div>", "a") is None


def test_small_rules(spark):
    assert one(spark, S.multi_values(F.lit("a ; b,c;; d"))) == ["a", "b,c", "d"]
    assert one(spark, S.html_escape(F.lit("<a href=\"x\">&'"))) == "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"
    assert one(spark, S.mib(F.lit(3 * 1048576))) == "3.0 MiB"
    assert tuple(one(spark, S.media_type(F.lit("Text/HTML; charset=\"UTF-8\"")))) == ("text/html", "utf-8")
    assert one(spark, S.job_id_of(F.lit("https://x.y/en-us/job/501826/slug"))) == "501826" and one(spark, S.job_id_of(F.lit("https://x.y/job/1"))) is None
    assert one(spark, S.page_url(F.lit("https://x.y/l?a=1"), F.lit(2), 20)) == "https://x.y/l?page=2&page-items=20"
    assert one(spark, S.page_url(F.lit("https://x.y/l"), F.lit(1), 20)) == "https://x.y/l"
    assert one(spark, S.label_key(F.lit(" Job No. "))) == "job_no"
    assert tuple(one(spark, S.capped(F.lit(b"abcdef"), 3))) == ("partial", bytearray(b"abc"))
    assert one(spark, S.redirect_class(F.lit("https://x.y/en-us/job/1"), F.lit("https://x.y/en-us/job/2"), F.lit(1))) == "to_other_job"
    values = F.array(F.struct(*(F.lit(v).cast("string").alias(n) for n, v in (("field_key", "k"), ("field_state", "s"), ("ordinal", "0"), ("origin", None), ("source_label", "é"), ("value_text", 'a"b')))))
    import hashlib
    import json

    blob = json.dumps([{"field_key": "k", "field_state": "s", "ordinal": "0", "origin": None, "source_label": "é", "value_text": 'a"b'}], ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    assert one(spark, S.metadata_fingerprint(values, "1.0.0")) == hashlib.sha256(f"metadata\x1f1.0.0\x1f{blob}\x1f".encode()).hexdigest()
    a, b = F.lit("x"), F.lit(None).cast("string")
    assert one(spark, S.page_signature(F.array(F.lit("1"), F.lit("2")), b)) == hashlib.sha256(b"1,2|").hexdigest() and one(spark, S.page_signature(F.array(a), a))
    assert one(spark, S.html_fingerprint(a, "1")) != one(spark, S.text_fingerprint(a, "1"))
