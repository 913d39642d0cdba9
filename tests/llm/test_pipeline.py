import corpus_pipeline as pipeline
from brookmart.llm import decontaminate, neardup, packing, rules, secrets
from brookmart.llm.common import stored
from brookmart.llm.tokens import vocabulary

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_is_kept(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert len(pipeline.STAGES) == 5
    now = docs
    for name, stage in pipeline.STAGES[:-1]:
        new = stored(stage(spark, now, SF), "test-stage")
        assert new.columns == docs.columns and dict(new.dtypes) == dict(docs.dtypes)
        before, after = {r.doc_id for r in now.collect()}, {r.doc_id for r in new.collect()}
        if name == "quality rules":
            want = {r.doc_id for r in rules.judge(now).filter("kept").collect()}
        elif name == "near copies":
            want = {r.component_id for r in neardup.near_duplicates(now).collect()}
        elif name == "benchmark passages":
            want = {r.doc_id for r in decontaminate.search(decontaminate.build_index(now), bench)
                    .filter("NOT contaminated").collect()}
        else:
            want = before
            assert not [r for r in secrets.scan(new).collect() if r.spans]
        assert after == want and new.count() == len(after)
        now = new
    got = pipeline.run(spark, SF).collect()
    want = packing.pack(now, vocabulary("byte_bpe_50k.json")).collect()
    def pieces(rows):
        return sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert pieces(got) == pieces(want)


def test_nothing_comes_of_nothing(spark, none):
    now = none.select(*pipeline.COLUMNS)
    for _, stage in pipeline.STAGES:
        now = stored(stage(spark, now, SF), "test-stage")
    assert now.count() == 0


def test_odd_rows_pass(spark, odd):
    now = odd
    for _, stage in pipeline.STAGES:
        now = stored(stage(spark, now, SF), "test-stage")
    assert now.count() > 0
