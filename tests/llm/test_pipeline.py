"""The pipeline against brute-force versions of its stages."""

import corpus_pipeline
from signalspark.llm.common import stored
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "test-stage")
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        if name != "best_fit_packing":
            assert docs.dtypes == columns and after.keys() <= before.keys() and len(rows) == len(after)
        texts = [(d, r.text) for d, r in before.items()]
        if name == "language_id":
            assert after.keys() == {d for d, t in texts if t and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            want = brute.repeated_words(texts, 50)
            for d, t in texts:
                left = len(brute.words(t)) - len(want[d])
                if not want[d]:
                    assert after[d] == before[d]
                else:
                    assert (len(brute.words(after[d].text)) if d in after else 0) == left and (left or d not in after)
            assert all(r.n_chars == len(r.text) for d, r in after.items() if want[d])
        elif name == "ngram_jaccard_join":
            assert after.keys() == {d for d, (_, c) in brute.jaccard_components(texts, 5, 80, 100).items() if c == d}
        elif name == "benchmark_decontamination":
            assert after.keys() == {d for d, t in texts if not any(i in " ".join(t.split()) for i in items)}
        else:
            assert {r.doc_id for r in rows} == before.keys()


def test_odd_rows_pass_through(spark, tmp_path):
    spark.createDataFrame([(1, None, None)], "item_id long, text string, doc_id long").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "words and letters", None, "s", 17), (4, "words and letters here", "en", "s", 22), (5, "words and letters here", "en", "s", 22), (6, "12 3", "en", "s", 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table, want in ((rows, {None, 4}), ([], set())):
        spark.createDataFrame(table, schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want


def test_columns_of_any_name_pass_through(spark, tmp_path):
    spark.createDataFrame([(1, "an item of the benchmark with some words in it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ("known", "score", "lang_pred", "runs", "run_doc", "n_deleted", "token", "whole", "gram", "place")
    rows = [(i, f"Some words of document {i} and {i * i} more of them here.", "en", "s", 50, *(f"{n}{i}" for n in names)) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), "test-names")
        assert sorted(map(tuple, docs.collect())) == rows
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).select("doc_id").distinct().count() == 8


def test_texts_in_no_learned_language_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = {
        "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
        "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
        "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。",
        "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    }
    planted = spark.createDataFrame([(10**6 + i, t * 2, None, "s", len(t)) for i, t in enumerate(other.values())], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.union(planted), SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
