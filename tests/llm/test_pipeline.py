from __future__ import annotations

from tests.llm.conftest import SCHEMA, odd, words


def test_stages(spark, tmp_path):
    import corpus_pipeline as p

    item, long = " ".join(words(30, 21)), words(120, 22)
    text = lambda k: "\n".join(" ".join(words(12, 100 * k + j)) for j in range(6))
    near = " ".join([*long[:60], "edit", *long[61:]])
    texts = [text(k) for k in range(1, 9)] + [text(1), " ".join(long), near, f"{text(11)} {item}", "123 456", None, ""]
    rows = [(k, t, "en", f"s{k % 2}", len(t) if t is not None else None) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = p.table(spark, str(tmp_path), "documents"), {}
    for name, stage in p.STAGES:
        docs = p.stored(stage(spark, docs, str(tmp_path)), name)
        left[name] = {r["doc_id"] for r in docs.collect()}
    clean = set(range(8))
    assert left["language"] == set(range(12)) and left["lines"] == set(range(12)) - {8} and left["near_copies"] == clean | {9, 11} and left["benchmark"] == clean | {9}
    assert left["mix"] <= left["benchmark"] and len(left["mix"]) >= 6


def test_near_copies_whose_common_lines_were_cut(spark, tmp_path):
    """The line stage leaves only what was changed in a near copy; it is told by its text as it came. Documents that share a line and no more stay."""
    import random

    import corpus_pipeline as p

    r, texts, copies = random.Random(41), [], set()
    line = lambda seed: " ".join(words(12, seed))
    shared = [line(10_000 + k) for k in range(5)]
    for k in range(60):
        own = [line(100 * k + j) for j in range(16)]
        texts.append([*own, r.choice(shared)])
    for k in range(0, 60, 2):
        again = list(texts[k])
        again[r.randrange(16)] = line(50_000 + k)
        copies.add(len(texts))
        texts.append(again)
    rows = [(k, "\n".join(t), "en", "s", 1) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words(30, 5)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = p.table(spark, str(tmp_path), "documents")
    for name, stage in p.STAGES[:3]:
        docs = p.stored(stage(spark, docs, str(tmp_path)), name)
    left = {x["doc_id"] for x in docs.collect()}
    assert left == set(range(60)) and not left & copies
    assert sum(t.count(x) for t in (x["text"] for x in docs.collect()) for x in shared) == 5


def test_stages_keep_columns_on_odd_rows(spark, tmp_path):
    import corpus_pipeline as p

    spark.createDataFrame([(1, "nothing of it here at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd(spark).selectExpr("*", "1 AS `mix_shard`", "2 AS `a.b`")
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        docs = p.stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
    name, stage = p.STAGES[-1]
    out = stage(spark, docs, str(tmp_path))
    assert set(columns) <= set(out.columns) and out.count() > 0


def test_shared_folder(spark, tmp_path, monkeypatch):
    """Tables lie in the application's own folder below the shared one, and clear() deletes that only."""
    from tidemark.llm import common

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert common.shared_dir(spark) == named if named else common.shared_dir(spark).startswith("file:///tmp/tidemark-")
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    (tmp_path / "other").mkdir()
    assert common.stored(spark.range(5), "five").count() == 5
    assert [p.name for p in tmp_path.iterdir() if p.name != "other"] == [f"tidemark-{spark.sparkContext.applicationId}"]
    common.remove_mounted(f"hdfs://{tmp_path}")
    assert len(list(tmp_path.iterdir())) == 2
    common.clear(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
    common.remove_mounted(f"file://{tmp_path}/other")
    assert not list(tmp_path.iterdir())


def test_tables_of_a_stage_are_deleted(spark, tmp_path, monkeypatch):
    """What a stage stored on its way goes when the next tables are written; of 40 tables and more the results stay."""
    import corpus_pipeline as p
    from tidemark.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}/shared")
    texts = ["\n".join(" ".join(words(12, 100 * k + j)) for j in range(6)) for k in range(8)]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate([*texts, f"{texts[0]}\nmore", "", None])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = p.table(spark, str(tmp_path), "documents")
    left = lambda: {f.name.rsplit("-", 1)[0] for f in (tmp_path / "shared").glob("*/*")}
    out = p.lines(spark, docs, str(tmp_path))
    assert left() == {"winnow-gone"} and out.count() == 11
    out = p.near_copies(spark, docs, str(tmp_path))
    assert left() <= {"winnow-gone", "pipeline-before", "pipeline-copies", "pipeline-repeats"}
    assert {r["doc_id"] for r in out.collect()} == {*range(8), 9, 10}
    common.clear(spark)
