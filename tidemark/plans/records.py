"""Queries over payloads, links, values, queues and reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import linediff as D
from tidemark.functions import markup as M
from tidemark.functions import scalars as S
from tidemark.operators import counters as C
from tidemark.operators import export as X
from tidemark.operators import qualify as Q
from tidemark.operators import views as V
from tidemark.plans.evidence import Evidence, query, text
from tidemark.sources import store
from tidemark.sources.stages import spread


def sql(name: str, statement: str | None = None):
    return query(name, statement, ctes=False)


# -- archive ----------------------------------------------------------------


@sql("archive_payloads", "SELECT sha256(text) AS sha256, CAST(any_value(strlen(text)) AS BIGINT) AS byte_length FROM documents GROUP BY 1")
def archive_payloads(e: Evidence) -> DataFrame:
    return store.addressed(e.table("documents").where("text IS NOT NULL"), "text").select("sha256", "byte_length")


@sql("archive_new_payloads", "SELECT DISTINCT sha256(text) AS sha256 FROM documents WHERE doc_id % 2 = 1 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0)")
def archive_new_payloads(e: Evidence) -> DataFrame:
    d = e.table("documents")
    return store.land(d.where("doc_id % 2 = 1"), store.addressed(d.where("doc_id % 2 = 0"), "text"), "text").select("sha256")


@sql("archive_damaged", "SELECT sha256(text) AS sha256, CAST(any_value(strlen(text)) AS BIGINT) AS byte_length FROM documents WHERE sha256(text)[1] IN ('0', '7') GROUP BY 1")
def archive_damaged(e: Evidence) -> DataFrame:
    """Payloads whose bytes were changed after they were archived: cut short for one first digit of the digest, swapped at equal length for another."""
    kept = store.addressed(e.table("documents"), "text")
    digit = F.substring("sha256", 1, 1)
    short = F.expr("substring(body, 2)")
    return store.damaged(kept.withColumn("body", F.when(digit == "0", short).when(digit == "7", F.concat(short, F.unhex(F.lit("00")))).otherwise(F.col("body"))))


@sql("archive_storage", "SELECT (SELECT count(*) FROM (SELECT DISTINCT text FROM documents)) AS artifacts, CAST((SELECT sum(strlen(text)) FROM (SELECT DISTINCT text FROM documents)) AS BIGINT) AS bytes_kept, count(*) AS fetches, CAST(sum(strlen(text)) AS BIGINT) AS bytes_fetched, round(sum(strlen(text)) / (SELECT sum(strlen(text)) FROM (SELECT DISTINCT text FROM documents)), 2) AS ratio FROM documents")
def archive_storage(e: Evidence) -> DataFrame:
    d = e.table("documents")
    return store.storage(d.select(F.octet_length("text").cast("long").alias("byte_length")), store.addressed(d, "text"))


@sql("foreign_key_gaps", "SELECT 'orders.o_custkey' AS foreign_key, count(*) AS missing FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'lineitem.l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def foreign_key_gaps(e: Evidence) -> DataFrame:
    count = lambda name, df: df.agg(F.count("*").alias("missing")).select(F.lit(name).alias("foreign_key"), "missing")
    a = count("orders.o_custkey", store.foreign_key_gaps(e.table("orders"), e.table("customer"), "o_custkey", "c_custkey"))
    return a.union(count("lineitem.l_orderkey", store.foreign_key_gaps(e.table("lineitem"), e.table("orders"), "l_orderkey", "o_orderkey")))


@sql("domain_violations", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1")
def domain_violations(e: Evidence) -> DataFrame:
    _, bad = store.in_domain(e.table("events"), "event_type", ("view", "click", "purchase"))
    return bad.groupBy("event_type").agg(F.count("*").alias("n"))


@sql("snapshot_manifest", 'SELECT \'customer\' AS "table", count(*) AS rows FROM customer UNION ALL SELECT \'nation\', count(*) FROM nation UNION ALL SELECT \'orders\', count(*) FROM orders')
def snapshot_manifest(e: Evidence) -> DataFrame:
    return store.manifest({n: e.table(n) for n in ("customer", "nation", "orders")}).select("table", "rows")


# -- text, links, fields ----------------------------------------------------


@sql("page_text")
def page_text(e: Evidence) -> DataFrame:
    return spread(e.table("pages")).select("page_id", M.html_text("html").alias("text"))


@sql("page_links")
def page_links(e: Evidence) -> DataFrame:
    links = spread(e.table("pages")).select("page_id", F.explode(M.html_links("html", "url")).alias("l")).select("page_id", "l.*")
    kind = S.link_class("url_resolved", "example.com", "jobs.example.com", "apply.example.net", "css_class")
    return links.select("page_id", "position", "url_raw", "url_resolved", "link_text", kind["class"].alias("classification"), kind["decision"].alias("decision"))


@sql("page_hosts", "SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host, starts_with(url, 'https://') OR starts_with(url, 'http://') AS web, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages")
def page_hosts(e: Evidence) -> DataFrame:
    scheme = F.try_parse_url("url", F.lit("PROTOCOL"))
    return e.table("pages").select("page_id", S.host_of("url").alias("host"), scheme.isin("http", "https").alias("web"), F.try_parse_url("url", F.lit("PATH")).alias("path"))


@sql("payload_decoding", "SELECT page_id, CASE WHEN starts_with(html, chr(65279)) THEN 'utf-8-sig' ELSE 'utf-8' END AS encoding, CAST(0 AS INTEGER) AS replaced, CAST(length(html) - CASE WHEN starts_with(html, chr(65279)) THEN 1 ELSE 0 END AS INTEGER) AS n_chars FROM pages")
def payload_decoding(e: Evidence) -> DataFrame:
    d = e.table("pages").select("page_id", M.html_decode(F.col("html").cast("binary"), F.lit("utf-8")).alias("d"))
    return d.select("page_id", "d.encoding", "d.replaced", F.length("d.text").alias("n_chars"))


_CELLS = "CASE event_id % 6 WHEN 0 THEN '=' || event_type WHEN 1 THEN '+' || event_type WHEN 2 THEN '-' || event_type WHEN 3 THEN '@' || event_type WHEN 4 THEN chr(9) || event_type ELSE event_type END"


@sql("spreadsheet_cells", f"SELECT event_id, CASE WHEN c[1] IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' || c ELSE c END AS cell FROM (SELECT event_id, {_CELLS} AS c FROM events)")
def spreadsheet_cells(e: Evidence) -> DataFrame:
    return e.table("events").select("event_id", F.expr(_CELLS).alias("cell")).select("event_id", S.spreadsheet_safe("cell").alias("cell"))


_STATUS = "CASE event_type WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 429 WHEN 1 THEN 503 ELSE 403 END WHEN 'signup' THEN 404 ELSE 200 END"
_BODY = "CASE event_id % 4 WHEN 0 THEN 'a CAPTCHA page' WHEN 1 THEN 'id=cf-browser-verification' ELSE 'ordinary' END"


@sql("access_control", f"SELECT signal, status, count(*) AS n FROM (SELECT status, CASE WHEN event_id % 11 = 0 THEN 'aws-waf-challenge' WHEN status = 429 THEN 'rate-limited' WHEN status = 503 AND body LIKE '%cf-browser-verification%' THEN 'cf-challenge' WHEN status = 403 AND lower(body) LIKE '%captcha%' THEN 'captcha' END AS signal FROM (SELECT event_id, CAST({_STATUS} AS BIGINT) AS status, {_BODY} AS body FROM events)) GROUP BY 1, 2")
def access_control(e: Evidence) -> DataFrame:
    rows = e.table("events").select(F.expr(_STATUS).cast("long").alias("status"), F.expr(_BODY).alias("body"), F.when(F.col("event_id") % 11 == 0, F.create_map(F.lit("x-amzn-waf-action"), F.lit("Challenge"))).alias("headers"))
    return rows.select(S.access_control("status", "headers", "body").alias("signal"), "status").groupBy("signal", "status").agg(F.count("*").alias("n"))


@sql("fetch_outcomes", f"SELECT event_type, count(*) FILTER (status = 200) AS ok, count(*) FILTER (status IN (408, 425, 429) OR status >= 500) AS retryable, count(*) AS n FROM (SELECT event_type, CAST({_STATUS} AS BIGINT) AS status FROM events) GROUP BY 1")
def fetch_outcomes(e: Evidence) -> DataFrame:
    none, done = F.lit(None).cast("string"), F.lit("complete")
    rows = e.table("events").select("event_type", F.expr(_STATUS).alias("status"))
    return rows.groupBy("event_type").agg(F.count_if(S.fetch_ok("status", done, none)).alias("ok"), F.count_if(S.retryable("status", done, none)).alias("retryable"), F.count("*").alias("n"))


@sql("capped_bodies", "SELECT doc_id, CASE WHEN strlen(text) > 1000 THEN 'partial' ELSE 'complete' END AS state, CAST(least(strlen(text), 1000) AS BIGINT) AS kept FROM documents")
def capped_bodies(e: Evidence) -> DataFrame:
    return e.table("documents").select("doc_id", S.capped(F.col("text").cast("binary"), 1000).alias("c")).select("doc_id", "c.state", F.length("c.body").cast("long").alias("kept"))


@sql("redirect_classes", "SELECT kind, count(*) AS n FROM (SELECT CASE event_id % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'to_listing' WHEN 2 THEN 'to_other_job' WHEN 3 THEN 'same_job_canonicalised' ELSE 'to_other' END AS kind FROM events) GROUP BY 1")
def redirect_classes(e: Evidence) -> DataFrame:
    base = F.concat(F.lit("https://jobs.example.com/en-us/job/"), F.col("event_id").cast("string"))
    k = F.col("event_id") % 5
    final = F.when(k == 0, base).when(k == 1, "https://jobs.example.com/en-us/listing/?x=1").when(k == 2, F.concat(base, F.lit("1/slug"))).when(k == 3, F.concat(base, F.lit("/slug"))).otherwise("https://www.example.com/")
    return e.table("events").select(S.redirect_class(base, final, F.lit(1)).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@sql("source_dates", "SELECT o_orderkey, state, precision, CAST(CASE WHEN state = 'parsed' AND precision = 'minute' THEN (strptime(d || ' 11:55 PM', '%b %d %Y %I:%M %p') AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' END AS VARCHAR) AS utc, CASE WHEN state = 'parsed' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS local_date FROM (SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%b %-d %Y') AS d, CASE o_orderkey % 4 WHEN 3 THEN 'unparsed' WHEN 2 THEN CASE WHEN strftime(o_orderdate, '%B') = strftime(o_orderdate, '%b') THEN 'parsed' ELSE 'invalid' END ELSE 'parsed' END AS state, CASE o_orderkey % 4 WHEN 0 THEN 'date' WHEN 1 THEN 'minute' WHEN 2 THEN 'date' ELSE 'unknown' END AS precision FROM orders)")
def source_dates(e: Evidence) -> DataFrame:
    day, k = F.date_format(F.to_date("o_orderdate"), "MMM d yyyy"), F.col("o_orderkey") % 4
    shown = F.when(k == 0, day).when(k == 1, F.concat(day, F.lit(" 11:55 PM"))).when(k == 2, F.date_format(F.to_date("o_orderdate"), "MMMM d yyyy")).otherwise("Closes when filled")
    return e.table("orders").select("o_orderkey", S.source_date(shown, F.lit(None).cast("string")).alias("d")).select("o_orderkey", "d.state", "d.precision", F.col("d.utc").cast("string").alias("utc"), F.col("d.local_date").cast("string").alias("local_date"))


@sql("field_pivot", "SELECT p_partkey AS entity_id, p_brand AS brand, p_type AS type, CAST(p_size AS VARCHAR) AS size FROM part")
def field_pivot(e: Evidence) -> DataFrame:
    values = e.table("part").selectExpr("p_partkey AS entity_id", "stack(3, 'brand', p_brand, 'type', p_type, 'size', cast(p_size AS string)) AS (field_key, value_text)", "0 AS ordinal")
    return V.pivot_fields(values, ["brand", "type", "size"])


@sql("unknown_labels", "SELECT regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g') AS field_key, p_brand AS source_label, count(*) AS n FROM part GROUP BY 1, 2")
def unknown_labels(e: Evidence) -> DataFrame:
    return e.table("part").groupBy(S.label_key("p_type").alias("field_key"), F.col("p_brand").alias("source_label")).agg(F.count("*").alias("n"))


@sql("text_statistics", "SELECT lang, count(*) AS n, CAST(min(length(text)) AS BIGINT) AS shortest, CAST(max(length(text)) AS BIGINT) AS longest, CAST(trunc(avg(length(text))) AS BIGINT) AS mean FROM documents GROUP BY 1")
def text_statistics(e: Evidence) -> DataFrame:
    return C.text_statistics(e.table("documents"), "lang")


@sql("field_conflicts", "SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS states FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1")
def field_conflicts(e: Evidence) -> DataFrame:
    found = C.conflicts(e.table("orders").select(F.col("o_custkey").alias("entity_id"), F.col("o_orderstatus").alias("value")))
    return found.select(F.col("entity_id").alias("o_custkey"), F.array_join("found", ",").alias("states"))


@sql("assessed_documents", "SELECT source, count(*) AS n, count(*) FILTER (quality = 1) AS qualified FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def assessed_documents(e: Evidence) -> DataFrame:
    return e.table("documents").join(e.table("labels"), "doc_id").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("qualified"))


@sql("latest_document_versions", "SELECT source, arg_max(doc_id, doc_id) AS doc_id, count(DISTINCT sha256(text)) AS versions, count(*) AS observations FROM documents GROUP BY 1")
def latest_document_versions(e: Evidence) -> DataFrame:
    return e.table("documents").groupBy("source").agg(F.max("doc_id").alias("doc_id"), F.count_distinct(F.sha2("text", 256)).alias("versions"), F.count("*").alias("observations"))


@sql("version_diff")
def version_diff(e: Evidence) -> DataFrame:
    """Unified line diff of each source's two newest documents."""
    w = Window.partitionBy("source").orderBy(F.desc("doc_id"))
    two = e.table("documents").withColumn("n", F.row_number().over(w)).where("n <= 2").groupBy("source").agg(F.max(F.when(F.col("n") == 1, F.col("text"))).alias("new"), F.max(F.when(F.col("n") == 2, F.col("text"))).alias("old"))

    return two.select("source", D.unified(D.line_diff("old", "new")).alias("diff"), (~F.col("old").eqNullSafe(F.col("new"))).alias("changed"))


# -- queues, resources, reports ---------------------------------------------


@sql("queue_summary", "SELECT o_orderstatus AS state, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1, 2")
def queue_summary(e: Evidence) -> DataFrame:
    queue = e.table("orders").select(F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("priority"))
    return C.queue_summary(queue, "state", "priority")


@sql("resource_associations", "SELECT l_partkey AS resource, count(DISTINCT l_orderkey) AS observations, count(*) AS links FROM lineitem GROUP BY 1")
def resource_associations(e: Evidence) -> DataFrame:
    return C.associations(e.table("lineitem").select(F.col("l_partkey").alias("resource"), F.col("l_orderkey").alias("observation")))


@sql("resource_outcomes", "SELECT l_returnflag AS outcome, l_linestatus AS state, count(*) AS n, max(l_orderkey) AS latest, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY 1, 2")
def resource_outcomes(e: Evidence) -> DataFrame:
    names = {"l_returnflag": "outcome", "l_linestatus": "state", "l_orderkey": "use_id", "l_linenumber": "size"}
    return C.resource_outcomes(e.table("lineitem").select(*(F.col(c).alias(n) for c, n in names.items())))


@sql("unlinked_resources", "SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40)")
def unlinked_resources(e: Evidence) -> DataFrame:
    links = e.table("lineitem").where("l_returnflag = 'R' AND l_quantity > 40").select(F.col("l_partkey").alias("resource"))
    return C.unlinked(e.table("part").select(F.col("p_partkey").alias("resource")), links).withColumnRenamed("resource", "p_partkey")


@sql("retry_sweep", "SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders WHERE o_orderstatus = 'P' AND o_orderkey <> 1 ORDER BY o_orderdate, o_orderkey LIMIT 20")
def retry_sweep(e: Evidence) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "P", "failed").otherwise("accepted")
    notices = e.table("orders").select(F.col("o_orderkey").alias("notice_id"), F.col("o_orderdate").alias("at"), state.alias("state"))
    return C.oldest_first(notices, F.col("notice_id") == 1, 20).select(F.col("notice_id").alias("o_orderkey"), F.col("at").cast("string").alias("o_orderdate"))


@query("export_postings", "SELECT posting_id, CAST(discovered_at AS VARCHAR) AS discovered_at, observations FROM postings ORDER BY posting_id")
def export_postings(e: Evidence) -> DataFrame:
    frames = {"postings": lambda: e.postings.select("posting_id", *text("discovered_at"), "observations")}
    return X.safe_cells(X.dataset(frames, "postings", ["posting_id"]))


@query("export_history_of_one", "SELECT posting_id, observation_id, CAST(observed_at AS VARCHAR) AS observed_at, availability FROM obs WHERE posting_id = 7 ORDER BY observed_at DESC, observation_id DESC LIMIT 25")
def export_history_of_one(e: Evidence) -> DataFrame:
    frames = {"history": lambda: e.obs.select("posting_id", "observation_id", *text("observed_at"), "availability")}
    return X.dataset(frames, "history", [F.desc("observed_at"), F.desc("observation_id")], posting=7, limit=25)


@query("export_versions", "SELECT posting_id, lineage, version, CAST(first_seen AS VARCHAR) AS first_seen, observed FROM versions")
def export_versions(e: Evidence) -> DataFrame:
    frames = {"versions": lambda: e.versions.select("posting_id", "lineage", "version", *text("first_seen"), "observed")}
    return X.dataset(frames, "versions", ["posting_id", "lineage", "version"])


@query("export_observations", "SELECT observation_id, o.posting_id, availability, p.posting_id IS NOT NULL AS registered FROM obs o LEFT JOIN (SELECT posting_id FROM postings WHERE observations > 60) p USING (posting_id)")
def export_observations(e: Evidence) -> DataFrame:
    known = e.postings.where("observations > 60").select("posting_id", F.lit(True).alias("registered"))
    return e.obs.join(known, "posting_id", "left").select("observation_id", "posting_id", "availability", F.coalesce("registered", F.lit(False)).alias("registered"))


@query("export_runs", "SELECT CAST(slot AS VARCHAR) AS slot, kind, outcome, pages, captured, mismatches FROM runs ORDER BY slot DESC")
def export_runs(e: Evidence) -> DataFrame:
    frames = {"runs": lambda: e.runs.select(*text("slot"), "kind", "outcome", "pages", "captured", "mismatches")}
    return X.dataset(frames, "runs", [F.desc("slot")])


