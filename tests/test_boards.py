"""Pages of our own making, read by the parsers."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import boards as B
from tidemark.functions import markup as M
from tidemark.functions import tape as T

BASE = "https://jobs.example.com/en-us/listing/"
HEAD = "<h2>Search results</h2><table><thead><tr><th>Position</th><th>Location</th><th>Closes</th></tr></thead>"
LISTING = f"""<html><body>{HEAD}
<tbody id="search-results-content">
<tr><td><a class="job-link" href="/en-us/job/101/clerk">Clerk &amp; <b>Aide</b></a></td><td><span class="location">Hill, Ohio</span></td><td><span class="close-date"><time datetime="2026-10-01T03:59:00Z">Sep 30 2026</time></span><span class="badge new">New</span></td></tr>
<tr class="summary"><td>Files <i>things</i>.</td></tr>
<tr><td><a class="job-link" href="/en-us/job/x">Odd</a></td></tr>
<tr><td>Only words</td></tr>
<tr><td></td></tr>
<tr class="summary"><td>goes with the empty row</td></tr>
<tr class="summary"><td>orphan</td></tr>
<tr><td><a class="job-link" href="/en-us/job/101">Clerk again</a></td></tr>
</tbody><tbody id="recent-jobs-content"><tr><td><a class="job-link" href="/en-us/job/7">Seven</a></td></tr></tbody></table>
<a class="more-link" href="?page=2&amp;page-items=20">More <span class="count"> 113 </span></a>
<a href="mailto:a@b.c">m</a><a href="/en-us/apply/1">a</a><a href="https://www.example.org/">w</a><a href="/en-us/help">h</a><a>none</a>
</body></html>"""


def test_listing():
    p = B.parse_listing(LISTING, BASE)
    assert (p["status"], p["structure_recognized"], p["empty_validated"], p["sections"]) == ("ok", True, False, ["search-results", "recent-jobs"])
    assert [(e["section"], e["position"], e["job_id"], e["state"], e["title"], e["summary"]) for e in p["entries"]] == [
        ("search-results", 1, "101", "resolved", "Clerk & Aide", "Files things."), ("search-results", 2, None, "unresolved_id", "Odd", None),
        ("search-results", 3, None, "unrecognized_row", "Only words", None), ("search-results", 4, "101", "resolved", "Clerk again", None), ("recent-jobs", 1, "7", "resolved", "Seven", None),
    ]
    first = p["entries"][0]
    assert (first["href_resolved"], first["location"], first["closes"], first["closes_machine"]) == ("https://jobs.example.com/en-us/job/101/clerk", "Hill, Ohio", "Sep 30 2026", "2026-10-01T03:59:00Z")
    assert first["summary_html"] == "Files <i>things</i>." and first["unknown_spans"] == [{"css_class": "badge", "text": "New"}, {"css_class": "new", "text": "New"}]
    assert (p["more_url"], p["more_remaining"]) == (BASE + "?page=2&page-items=20", 113)
    assert [x["link_text"] for x in p["other_links"]] == ["More  113", "m", "a", "w", "h"]
    assert [n for n in p["notes"]] == [B.Note("link_without_job", 2, "/en-us/job/x"), B.Note("summary_without_row", 6, "search-results")]


@pytest.mark.parametrize(
    ("html", "recognized", "empty"),
    [
        (HEAD + "<tbody id='search-results-content'></tbody></table>", True, True), ("<tbody id='search-results-content'></tbody>", True, False), ("<table><tbody id='search-results-content'></tbody></table>", True, False),
        ("<h1>503</h1>", False, False), ("", False, False), (None, False, False), (HEAD, False, False),
    ],
)
def test_empty_listings(html, recognized, empty):
    p = B.parse_listing(html, BASE)
    assert (p["structure_recognized"], p["empty_validated"], p["entries"], p["more_url"]) == (recognized, empty, [], None)


def test_more_links():
    more = lambda inner: B.parse_listing(f"<a class='x more-link' href='?page=3'>{inner}</a>", BASE)
    assert more("More")["more_remaining"] is None and more("More")["notes"][-1].code == "next_page_without_count"
    assert more("<span class=count>many</span>")["more_remaining"] is None and more("<span class=count>7 left</span>")["more_remaining"] == 7


DETAIL = """<html><body><ul id="message-list"></ul><div id="job"><div id="job-content"><h2>Night <em>Clerk</em></h2>
<p><b>Job no:</b> <span class="job-externalJobNo"> 501 </span><br><b>Location:</b> Hill, Ohio; Vale, Ohio<br><b>Categories:</b><br><b>Shoe size:</b> 44 <b>not a label</b> wide<br></p>
<div id="job-details"><p><b>Summary:</b> Evening lifts have been filled with oats.</p><p>See <a href="/files/a.PDF">the form</a>, <a href="mailto:x@y.z">us</a> and <a href="/files/a.PDF">again</a>.</p></div>
<p><b>Advertised:</b> <span class="open-date"><time datetime="2026-09-15T04:00:00Z">Sep 15 2026 </time></span> Eastern Time<br><b>Applications close:</b> <span>until filled</span><br><b>Location:</b> Second</p>
<a class="apply-link" href="/en-us/apply/501">Apply</a></div></div></body></html>"""


def test_detail():
    p = B.parse_detail(DETAIL, "https://jobs.example.com/en-us/job/501")
    assert (p["status"], p["title"], p["job_id"], p["html_kind"], p["closure"]) == ("ok", "Night Clerk", "501", "source-substring", None)
    assert p["description_html"].startswith("<p><b>Summary:</b> Evening") and p["description_html"].endswith("again</a>.</p>")
    assert p["description_text"] == "Summary: Evening lifts have been filled with oats.\n\nSee the form, us and again."
    f = {(x["field_key"], x["ordinal"]): x for x in p["fields"]}
    assert list(f) == [("job_no", 0), ("location", 0), ("categories", 0), ("shoe_size", 0), ("advertised", 0), ("applications_close", 0), ("location", 1)]
    assert f["location", 0]["parts"] == ["Hill, Ohio", "Vale, Ohio"] and f["categories", 0]["field_state"] == "absent" and f["shoe_size", 0]["value_text"] == "44 not a label wide"
    assert not f["shoe_size", 0]["known_label"] and f["location", 1]["value_text"] == "Second"
    a = f["advertised", 0]
    assert (a["is_date"], a["date_display"], a["date_machine"], a["date_zone"]) == (True, "Sep 15 2026", "2026-09-15T04:00:00Z", "Eastern Time")
    assert f["applications_close", 0]["date_display"] == "until filled"
    assert [(x["parent_kind"], x["url_raw"], x["position"]) for x in p["links"]] == [
        ("posting_description", "/files/a.PDF", 1), ("posting_description", "mailto:x@y.z", 2), ("job_content", "/files/a.PDF", 3), ("job_content", "mailto:x@y.z", 4), ("job_content", "/en-us/apply/501", 5),
    ]
    assert [n.code for n in p["notes"]] == ["unknown_label"]


@pytest.mark.parametrize(
    ("html", "status", "closure"),
    [
        ("<p>nothing</p>", "failed", None), (None, "failed", None), ("<div id=job-content> </div>", "ok", ("empty-job-content", None)), ("<div id=job style='display: NONE'><div id=job-content>x</div></div>", "ok", ("empty-job-content", None)),
        ("<div id=job-content><h1>t</h1>This position is no longer open</div>", "partial", ("content", "position is no longer")), ("<ul id=message-list><li>Job not found</ul><div id=job-content>x</div>", "partial", ("messages", "job not found")),
        ("<ul id=message-list><li>Cookies!</ul><div id=job-content>x<div id=job-details>has been filled</div></div>", "ok", None),
    ],
)
def test_closures(html, status, closure):
    p = B.parse_detail(html, BASE)
    assert (p["status"], p["closure"] and (p["closure"]["place"], p["closure"]["phrase"])) == (status, closure)


def test_description_written_anew():
    """What has the id in a script or comment is no element; what is open to the end can't be cut."""
    html = "<div id=job-content><h1>t</h1><script>var x = '<div id=job-details>no</div>'</script><!-- <div id=job-details>no</div> --><div id=job-details>a &amp; <b>b</b><br>c</div></div>"
    p = B.parse_detail(html, BASE)
    assert p["html_kind"] == "source-substring" and p["description_html"] == "a &amp; <b>b</b><br>c"
    p = B.parse_detail("<div id=job-content><div id=job-details>open <b>end", BASE)
    assert p["html_kind"] == "reserialized" and p["description_html"] == "open <b>end</b>" and B.Note("description_written_anew", 2) in p["notes"]


def test_job_number_from_its_label():
    p = B.parse_detail("<div id=job-content><b>Job no:</b> 77<br></div>", BASE)
    assert p["job_id"] == "77"
    assert B.job_id("https://x.example/en-us/job/12/some/slug") == "12" and B.job_id("/job/12") is None and B.job_id("http://[bad") is None


def test_links_as_columns(spark):
    page = DETAIL.replace("</body>", "").replace("<a class=\"apply-link\"", "<a href='http://[bad'>b</a><a href='#top'>t</a><a href='/b.csv' class='x employee-referral-link'>r</a><a class=\"apply-link\"")
    df = spark.createDataFrame([(page, LISTING)], "d string, l string")
    links = df.select(F.explode(B.detail("d", F.lit("https://jobs.example.com/en-us/job/501"), "example.com", "jobs.example.com")["links"]).alias("x")).select("x.*").collect()
    assert [(r["classification"], r["decision"], r["reason"]) for r in links] == [
        ("job_document", "fetch", None), ("mailto", "exclude", "address_of_mail"), ("job_document", "fetch", None), ("mailto", "exclude", "address_of_mail"), ("external", "exclude", "another_site"),
        ("internal_nav", "exclude", "way_around_the_board"), ("apply_workflow", "exclude", "application"), ("apply_workflow", "exclude", "application"),
    ]
    others = df.select(F.explode(B.listing("l", F.lit(BASE), "jobs.example.com")["other_links"]).alias("x")).select("x.classification").collect()
    assert [r[0] for r in others] == ["internal_nav", "mailto", "apply_workflow", "external", "internal_nav"]


def test_a_page_is_read_once(spark):
    df = spark.createDataFrame([(DETAIL,)], "d string").select(B.detail("d", F.lit(BASE), "example.com", "jobs.example.com").alias("p"))
    rows = df.select("p.title", "p.job_id", F.explode("p.fields").alias("f")).select("title", "f.field_key")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and rows.count() == 7


DEEP = 30_000


@pytest.mark.parametrize("body", ["<span>" * 100_000 + "end", "<div>" * 100_000 + "end" + "</div>" * 100_000, "<p> " * DEEP, "<br> " * DEEP, "<b>A:</b>" * (DEEP // 4), "<b>" * DEEP + "A:", "<li>x<span>" * (DEEP // 2), "<a href=x>" * (DEEP // 2), "</b>" * DEEP, "<ul>" + "<span>" * DEEP + "<li>y</li>" * DEEP, "<table>" + "<tr><td>" * (DEEP // 4)])
def test_hostile_pages_take_linear_time(body):
    began = time.monotonic()
    p = B.parse_detail(f"<div id=job-content><h1>t</h1><div id=job-details>{body}</div></div>", BASE)
    assert p["status"] == "ok" and p["title"] == "t"
    B.parse_detail(f"<div id=job-content><h1>t</h1>{body}</div>", BASE)
    M.markup_text(body)
    T.slice_by_id(f"<i id=q>{body}</i>", "q")
    assert time.monotonic() - began < 60


def test_tangled_pages_fail_and_say_so(spark):
    nested = "<div id=job-content><h1>t</h1>" + "<div><b>A:</b> x " * 4_000
    rows = "<tbody id=search-results-content>" + "<tr><td>x<table>" * 4_000
    df = spark.createDataFrame([(nested, rows), (DETAIL, LISTING)], "d string, l string")
    got = df.select(B.detail("d", F.lit(BASE), "example.com", "jobs.example.com").alias("d"), B.listing("l", F.lit(BASE), "jobs.example.com").alias("l")).select("d.status", "d.failure", F.col("l.status").alias("ls"), F.col("l.failure").alias("lf")).collect()
    assert (got[0]["status"], got[0]["failure"]) == ("failed", "Tangled: its parts overlap too often") and (got[0]["ls"], got[0]["lf"]) == ("failed", "Tangled: its parts overlap too often")
    assert (got[1]["status"], got[1]["failure"], got[1]["ls"], got[1]["lf"]) == ("ok", None, "ok", None)


def test_slices():
    assert T.slice_by_id("<p><img id=a src=x>y", "a") == "<img id=a src=x>" and T.slice_by_id("<i id='a' />", "a") == "<i id='a' />"
    assert T.slice_by_id("a\0\n<b id=x>c\0d</b >e", "x") == "<b id=x>c\0d</b >" and T.slice_by_id("<b id=x>open", "x") is None and T.slice_by_id(None, "x") is None
    page = T.Page("<div id=a>x &lt; <p>y<p>z</div>\n<ul><li id=b>1<li id=c>2</ul>")
    assert page.inner_source(page.by_id("a")) == "x &lt; <p>y<p>z" and page.inner_source(page.by_id("b")) is None and page.text(page.by_id("b")) == "1"
    assert page.outer_source(page.by_id("a")).endswith("z</div>") and page.raw_text(0) == "x < yz\n12"


def test_as_columns(spark):
    df = spark.createDataFrame([(1, LISTING, DETAIL), (2, None, None)], "k long, a string, b string")
    out = df.select("k", B.listing("a", F.lit(BASE), "jobs.example.com").alias("l"), B.detail("b", F.lit(BASE), "example.com", "jobs.example.com").alias("d"))
    rows = out.select("k", B.unique_ids("l").alias("ids"), B.unresolved("l").alias("n"), "d.title", "d.status").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, ["101"], 2, "Night Clerk", "ok"), (2, [], 0, None, "failed")]


@pytest.mark.parametrize("charset", ["undefined", "\0x", "rot13", "hex", "idna", "no-such", "utf-7x"])
def test_hostile_charsets(charset):
    d = M.decode_bytes("é".encode(), charset)
    assert (d["text"], d["encoding"]) == ("é", "utf-8")
    assert M.decode_bytes(f"<meta charset={charset.strip(chr(0))}>é".encode())["text"].endswith("é")


def test_preformatted_text_is_kept():
    assert M.markup_text("<p> a  b </p><pre> x\n\n\n  y </pre><p>c</p>") == "a b\n\n x\n\n\n  y \n\nc"
    assert M.markup_text("<pre>  in </pre>") == "  in " and M.markup_text("a \n b<br> c") == "a b\nc"


def test_decoding_holds_a_slice_of_a_batch():
    """Of a batch of 1,000 pages at most two slices are Python objects at once."""
    import weakref

    import pyarrow as pa

    class Row(dict):
        pass

    alive, most = weakref.WeakSet(), 0

    def of(data, declared):
        nonlocal most
        row = Row(M.decode_bytes(data, declared))
        row.__class__.__hash__ = object.__hash__
        alive.add(row)
        most = max(most, len(alive))
        return row

    data = [f"page {k} é".encode("cp1252" if k % 3 else "utf-8") for k in range(1_000)]
    out = M.by_slices(of, pa.struct(M._DECODED), pa.array(data), pa.array([None] * 1_000, pa.string()))
    assert out.to_pylist() == [M.decode_bytes(d) for d in data] and most <= 2 * M.SLICE
    assert M._html_decode(pa.array([], pa.binary()), pa.array([], pa.string())).to_pylist() == []


def test_links_hold_a_slice_of_a_batch(monkeypatch):
    """Links of a batch are Arrow arrays, slice by slice, equal to those of each page by itself."""
    import pyarrow as pa

    monkeypatch.setattr(M, "SLICE", 3)
    pages = [f"<a href='/p{k}' class=x>one</a><a href='/p{k}'>again</a><a rel=r href='http://['>bad</a>" for k in range(10)] + [None, ""]
    out = M._html_links(pa.array(pages), pa.array(["https://a.example/"] * 12)).to_pylist()
    assert [len(x) for x in out] == [2] * 10 + [0, 0]
    assert out[4][0] == {"url_raw": "/p4", "url_resolved": "https://a.example/p4", "link_text": "one", "rel": None, "css_class": "x", "position": 1} and out[4][1]["url_resolved"] == "http://["


def test_equal_pages_are_read_once(monkeypatch):
    """10,000 pages of 10 dates take 10 readings; fields are those of the whole reading, also of pages that are null or no details."""
    import pyarrow as pa

    read, seen = B.parse_detail, []
    monkeypatch.setattr(B, "parse_detail", lambda m, b: seen.append(m) or read(m, b))
    B._remembered.cache_clear()
    page = lambda k: f"<div id=job-content><h1>x</h1><p><b>Closes:</b> <span><time>Sep {k} 2026 </time></span> Eastern<br><b>Odd:</b> y</p></div>"
    pages = [page(k % 10) for k in range(10_000)]
    out = B._detail_fields(pa.array(pages)).to_pylist()
    assert len(seen) == 10 and out[:10] == [read(m, None)["fields"] for m in pages[:10]] and out[17] == out[7]
    odd = [None, "", "no page", page(3), None]
    assert B._detail_fields(pa.array(odd)).to_pylist() == [[dict(f) for f in read(m, None)["fields"]] for m in odd]


def test_slices_leave_at_once():
    """The results of a slice are on their way before the next one is read."""
    import pyarrow as pa

    read = []

    def of(markup, base):
        read.append(len(markup))
        return M._html_links(markup, base)

    pages, base = pa.array([f"<a href='/{k}'>x</a>" for k in range(1_000)]), pa.array(["https://a.example/"] * 1_000)
    out = M.slices(of, iter([(pages, base), (pages.slice(0, 0), base.slice(0, 0))]))
    first = next(out)
    assert len(first) == M.SLICE and read == [M.SLICE]
    assert pa.concat_arrays([first, *out]).equals(M._html_links(pages, base))
