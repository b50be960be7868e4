import corpus_pipeline
from tributary.llm.common import materialise
from tributary.llm.decontaminate import find_contained
from tributary.llm.quality import classify
from tributary.llm.simhash import similar_groups
from tributary.llm.toxicity import score_documents

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark):
    table = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    docs = table("documents")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SF), name)
        ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if name == "quality":
            wanted = [r.doc_id for r in classify(before, table("labels")).where("kept").collect()]
        elif name == "toxicity":
            wanted = [r.doc_id for r in score_documents(before, table("labels")).where("predicted = 0").collect()]
        elif name == "near_dedup":
            wanted = [r.group_id for r in similar_groups(before).select("group_id").distinct().collect()]
        elif name == "decontamination":
            bad = {r.doc_id for r in find_contained(before, table("benchmark")).collect()}
            wanted = [r.doc_id for r in before.collect() if r.doc_id not in bad]
        else:
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}
            continue
        assert ids == sorted(wanted) and docs.columns == before.columns and 0 < len(ids) <= before.count()


def test_odd_documents_pass_all_stages(spark, tmp_path):
    """Nulls, empty texts, repeated rows and ids, a very long text and columns with clashing names; then no document at all."""
    import shutil

    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path)
    plain = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    first = plain.where("length(text) > 300").orderBy("doc_id").limit(3)
    odd = first.unionByName(first).unionByName(plain.where("doc_id < 3").selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars"))
    odd = odd.unionByName(first.limit(1).selectExpr("doc_id + 100000 as doc_id", "repeat(text || ' ', 300) text", "cast(null as string) lang", "source", "n_chars"))
    odd = odd.unionByName(first.limit(1).selectExpr("cast(null as bigint) doc_id", "'' text", "lang", "source", "n_chars"))
    odd = odd.selectExpr("*", "1 as score", "'x' as label", "2 as k", "3 as item_id", "4 as fp", "5 as h", "6 as kid")
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    for rows in (spark.read.parquet(str(tmp_path / "documents.parquet")), odd.limit(0)):
        docs = materialise(rows, "odd")
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, materialise(stage(spark, docs, str(tmp_path)), name)
            if name != "packing":
                assert docs.columns == before.columns and docs.count() <= before.count()
                assert docs.exceptAll(before).count() == 0
        assert docs.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0
