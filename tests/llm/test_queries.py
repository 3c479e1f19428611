"""Every registered query of the subpackage on one small input with nulls, repeats, ties and very long texts."""

from __future__ import annotations

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, odd, words
from tidemark.llm import registry

COLUMNS = {
    "op1_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2_lm_score": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op3_quality": "doc_id bigint, perplexity double, keep boolean", "op4_line_dedup": "doc_id bigint, n_lines bigint, n_removed bigint, text string", "op5_decontaminate": "doc_id bigint, item_id bigint, n_item bigint, n_found bigint",
    "op6_media_chunks": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op7_source_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint", "op8_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9_parity_join": "doc_id bigint, n_shingles bigint, component_id bigint", "op10_chain_dedup": "doc_id bigint, src_id bigint, start_word bigint, end_word bigint, identity double",
    "op11_divergence": "lang string, source string, part string, item string, value bigint, rank int",
    "op12_spelling": "word string, form string, root string, n bigint, n_near bigint, form_n bigint", "op13_simhash": "doc_id bigint, fingerprint string, component_id bigint",
}
LONG = words(60_000, 91)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    near = [w if k % 400 else "edited" for k, w in enumerate(LONG)]
    item = words(30, 92)
    rows = [(100, " ".join(LONG), "en", "long", 1), (101, " ".join(near), "en", "long", 1), (102, f"x {' '.join(item)} token=abcdefghijklmnop y", None, None, 1), (103, f"x {' '.join(item)} token=abcdefghijklmnop y", "fr", "t", 1)]
    docs = odd(spark).unionByName(spark.createDataFrame(rows, SCHEMA), allowMissingColumns=True)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item)), (None, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(100, 1, 0), (4, 1, 0), (102, 0, 1), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, {(r["doc_id"], r["text"]) for r in docs.collect()}, docs.count()


def held_out(doc_id, mod):
    return zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % mod == 0


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, tables, name):
    path, docs, n = tables
    out = registry.QUERIES[name](spark, path)
    assert {c.strip() for c in COLUMNS[name].split(",")} <= {f"{k} {v}" for k, v in out.dtypes}
    rows = out.collect()
    texts: dict = {}
    for d, t in docs:
        texts.setdefault(d, []).append(t)
    if name not in ("op5_decontaminate", "op10_chain_dedup", "op11_divergence", "op12_spelling"):
        assert len(rows) == n
    if name == "op1_language_id":
        assert all(r["held_out"] == held_out(r["doc_id"], 5) and 0 <= r["score"] <= 1 for r in rows) and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    if name == "op2_lm_score":
        assert all(r["held_out"] == held_out(r["doc_id"], 10) and r["n_tokens"] == size(texts[r["doc_id"]][0]) + 1 and r["score"] < 0 for r in rows)
    if name == "op5_decontaminate":
        assert {(r["doc_id"], r["item_id"]) for r in rows} == {(102, 1), (103, 1)}
    if name == "op6_media_chunks":
        for r in rows:
            raw = (texts[r["doc_id"]][0] or "").encode()
            data = raw + b"\0" * (64 if not raw else -len(raw) % 64)
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:])) and r["media_bytes"] > len(data)
    if name == "op7_source_mix":
        assert all(r["size"] == size(texts[r["doc_id"]][0]) and r["taken"] <= 2 * r["size"] for r in rows)
        again = {(r["doc_id"], r["size"], r["taken"]) for r in registry.QUERIES[name](spark, path).collect()}
        assert again == {(r["doc_id"], r["size"], r["taken"]) for r in rows}
    if name == "op8_secrets":
        assert {r["doc_id"]: r["n_assign"] for r in rows}[102] == 1
    if name == "op9_parity_join":
        found = {r["doc_id"]: r["component_id"] for r in rows}
        assert (found[101], found[103], found[5], found[None]) == (100, 102, 4, None)
    if name == "op11_divergence":
        assert {(r["lang"], r["source"], r["item"]) for r in rows if r["part"] == "pair"} >= {("", "", "t"), ("", "t", ""), ("en", "", "long")} and all(r["value"] == 0 for r in rows)
    if name == "op12_spelling":
        assert all(r["n"] >= 5 and len(r["word"]) >= 6 for r in rows) and any(r["word"] == "edited" for r in rows)
    if name == "op13_simhash":
        found = {r["doc_id"]: r["component_id"] for r in rows}
        assert (found[2], found[5], found[103], found[None]) == (1, 4, 102, None)
    if name == "op10_chain_dedup":
        got = {(r["doc_id"], r["src_id"]): (r["start_word"], r["end_word"], r["identity"]) for r in rows}
        assert set(got) == {(5, 4), (101, 100)} and got[101, 100][1] - got[101, 100][0] > 59_000 and got[101, 100][2] > 0.99


def test_pipeline_of_the_same_tables(spark, tables):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, tables[0])
    assert {"doc_id", "text", "mix_shard"} <= set(out.columns)
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert not kept & {1, 2, 3, 101, 102, 103} and 100 in kept
    assert out.where(F.col("text").isNull()).count() == 0
