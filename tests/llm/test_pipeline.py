"""The pipeline's stages one by one, and its registration."""

import random

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from conftest import SF_SMALL
from wordlens.llm import quality, simhash, substring, tiling
from wordlens.session import materialize


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    given = docs
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, given, SF_SMALL), "test")
        ids = {r.doc_id for r in given.select("doc_id").collect()}
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= ids
        if name == "best-fit packing":
            assert kept == ids and {"sequence_id", "offset", "length"} <= set(out.columns)
            break
        assert out.dtypes == docs.dtypes
        if name == "quality classifier":
            labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
            assert kept == {r.doc_id for r in quality.score_quality(given, labels).where("keep").collect()}
        elif name == "SimHash near-dedup":
            assert kept == {r.component_id for r in simhash.near_duplicates(given).collect()}
        elif name == "substring dedup":
            digest = {r.doc_id: (r.n_words, r.n_removed) for r in substring.removal_digest(given).collect()}
            assert kept == {d for d, (n, gone) in digest.items() if gone < n or not n}
            assert {r.doc_id: len((r.text or "").split()) for r in out.collect()} == {
                d: n - gone for d, (n, gone) in digest.items() if d in kept}
        else:
            items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            assert kept == ids - {r.doc_id for r in tiling.contaminated_pairs(given, items).collect()}
        given = out
    assert sorted(map(tuple, pipeline.run(spark, SF_SMALL).select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, out.select("doc_id", "piece", "ids_crc32").collect()))


def test_planted_cases(spark, tmp_path):
    """Junk and toxic texts, copies, a repeated passage and a test item go; clean documents stay whole."""
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    clean = [text(200) for _ in range(60)]
    passage, item = text(90), text(40)
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100, clean[0]), (101, clean[1] + " x"), (110, text(150) + " " + passage), (111, passage + " " + text(150)),
             (120, text(100) + " " + item + " " + text(100))]
    rows += [(200 + i, text(80) + " vile nasty " + text(20)) for i in range(40)]
    rows += [(300 + i, text(60).upper().replace(" ", "!! ")) for i in range(40)]
    docs = spark.createDataFrame([(d, t, "en", "src", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, 1, 0) for i in range(40)] + [(200 + i, 1, 1) for i in range(30)] + [(300 + i, 0, 0) for i in range(30)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(pipeline.STAGES)
    given, texts = docs, None
    for name in list(stages)[:-1]:
        given = materialize(stages[name](spark, given, str(tmp_path)), "test")
    texts = {r.doc_id: r.text for r in given.collect()}
    assert {i: texts.get(i) for i in range(60)} == dict(enumerate(clean))
    assert set(texts) - set(range(60)) == {110, 111}
    assert passage in texts[110] and passage not in texts[111]


def test_registered_queries():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "substring dedup",
                                               "benchmark decontamination", "best-fit packing"]


def test_clashing_columns_pass_through_every_stage(spark):
    """Columns named like those that the stages make are carried as they are."""
    names = "_id _th _key id ID_ th hash key marks text_hash keep root fp component_id item_id ids word row".split()
    names = [n for n in names if n.lower() not in {m.lower() for m in names[:names.index(n)]}]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plain, wide = docs, docs.withColumns({n: F.concat(F.lit(f"{n}:"), "doc_id") for n in names})
    for name, stage in pipeline.STAGES[:-1]:
        plain, wide = materialize(stage(spark, plain, SF_SMALL), "test"), materialize(stage(spark, wide, SF_SMALL), "test")
        assert wide.columns == docs.columns + names
        assert sorted(map(tuple, wide.select(docs.columns).collect())) == sorted(map(tuple, plain.collect())), name
        assert wide.where(" or ".join(f"`{n}` is null or `{n}` <> concat('{n}:', doc_id)" for n in names)).isEmpty(), name
    assert pipeline.STAGES[-1][1](spark, wide, SF_SMALL).count() == pipeline.STAGES[-1][1](spark, plain, SF_SMALL).count()
