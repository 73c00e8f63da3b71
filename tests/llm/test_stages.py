from collections import Counter

from pyspark.sql import functions as F

from llm.frames import awkward, documents


def test_stages_on_awkward_rows(spark):
    import corpus_pipeline as C
    from bazaarlens.llm.common import written

    docs, sizes = written(documents(spark, extra=False), "docs"), []
    for name, stage in C.STAGES:
        before = docs
        docs = written(stage(spark, docs.withColumn("rows", F.lit(1)) if name != "pack" else docs, ""), name)
        sizes.append(docs.count())
        if name != "pack":
            assert docs.columns == list(C.COLUMNS)
        if name == "language_id":
            kept = Counter(r[0] for r in docs.select("doc_id").collect())
            assert kept == Counter(r[0] for r in awkward() if r[0] not in (5, 6, 7)) and docs.where("lang is null").count() == 0
        if name == "simhash_dedup":
            # both texts of id 12 stay, one row of each
            assert Counter(r[0] for r in docs.collect())[12] == 2 and docs.count() == docs.select("doc_id", "text").distinct().count()
            assert {0, 3, 9, 12} <= {r[0] for r in docs.select("doc_id").collect()} and not {1} & {r[0] for r in docs.select("doc_id").collect()}
        if name == "mix_sources":
            assert docs.subtract(before).count() == 0 and docs.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0] <= 2
    assert len(C.STAGES) == 5 and all(sizes)


def test_simhash_stage_keeps_one_of_each_group(spark):
    import corpus_pipeline as C
    from bazaarlens.llm.simhash import simhash_groups

    docs = documents(spark, extra=False)
    groups = simhash_groups(docs, with_root=True).select("root").distinct().count()
    assert C.simhash_dedup(spark, docs, "").count() == groups


def test_unlike_texts_under_one_id_or_none_all_stay(spark):
    import random

    import corpus_pipeline as C
    from llm.frames import WORDS, prose

    rng = random.Random(8)
    texts = [prose(rng, WORDS["en"], 60) for _ in range(12)]
    rows = [(None, t, "en", "s", 1) for t in texts[:10] + texts[:4]] + [(None, None, "en", "s", 1), (5, texts[10], "en", "s", 1), (None, texts[10], "en", "s", 1), (6, texts[11], "en", "s", 1)]
    got = C.simhash_dedup(spark, documents(spark, rows, extra=False), "").collect()
    shared = C.simhash_dedup(spark, documents(spark, [(7, t, "en", "s", 1) for t in texts * 2] + [(8, texts[0], "en", "s", 1)], extra=False), "").collect()
    assert Counter((r["doc_id"], r["text"]) for r in shared) == Counter([(7, t) for t in texts])
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter([(None, t) for t in texts[:10]] + [(None, None), (5, texts[10]), (6, texts[11])])


def test_mixed_rows_without_an_id_have_their_own_copies(spark):
    import corpus_pipeline as C
    from bazaarlens.llm.mixing import mix

    rows = [(None if k % 3 else k // 6, "w " * (k % 7 + 1) + str(k), "en", f"s{k % 2}", 1) for k in range(90)] + [(None, "again and again", "en", "s1", 1)] * 5
    docs = documents(spark, rows, extra=False)
    got = Counter(tuple(r) for r in C.mix_sources(spark, docs, "").collect())
    tagged = docs.withColumn("tag", F.xxhash64(*C.COLUMNS[1:]))
    want = Counter()
    for r in mix(tagged, tag_col="tag").join(tagged.select("tag", *C.COLUMNS[1:]).distinct(), "tag").collect():
        want[tuple(r[c] for c in C.COLUMNS)] += r["copies"]
    assert got == +want and len(set(want.values())) > 1


def test_empty_pipeline(spark, tmp_path):
    import corpus_pipeline as C

    documents(spark, [], extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_pipeline_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)
