from pyspark.sql import functions as F

from docvec.llm import language, queries

WORDS = {
    "en": "the house and the garden with a river that we saw",
    "de": "das haus und der garten mit einem fluss den wir sahen",
    "fr": "la maison et le jardin avec une rivière que nous avons vue",
    "es": "la casa y el jardín con un río que vimos nosotros",
    "xx": "zzgu wokk iibba zzgu qqu wokkra iibbo",
}


def labelled(spark, n=12):
    rows = [(100 * i + k, " ".join(w.split()[k % 5 :]), code, "s") for i, (code, w) in enumerate(WORDS.items()) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_learns_families_and_members(spark):
    model = language.fit(labelled(spark))
    assert model.families == ["germanic", "only xx", "romance"]
    langs, scores = model.predict([*WORDS.values(), None or "", "123 !?", "É" * 5])
    assert langs[:5] == list(WORDS) and langs[5:7] == ["und", "und"] and langs[7] != "und"
    assert all(0 <= s <= 1 for s in scores) and scores[5] == 0


def test_prediction_depends_on_the_text_alone():
    model = language.train(["en", "de"] * 5, [language.counts(WORDS[c]) for c in ("en", "de") * 5])
    texts = [WORDS["de"], "a", WORDS["en"] * 40_000, "ü", WORDS["en"]]
    together = model.predict(texts)
    alone = [model.predict([t]) for t in texts]
    assert together[0] == [a[0][0] for a in alone] and together[1] == [a[1][0] for a in alone]


def test_edges(spark):
    empty = labelled(spark).limit(0)
    model = language.fit(empty)
    rows = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "the house", "en"), (3, "the house", "en")], "doc_id long, text string, lang_pred string")
    got = language.identify(rows, model).orderBy("doc_id").collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 4
    assert language.identify(rows.limit(0), model).collect() == []
    one = language.fit(labelled(spark).where("lang = 'en'"))
    assert [r["lang_pred"] for r in language.identify(rows, one).orderBy("doc_id").collect()] == ["und", "und", "en", "en"]


def test_sample_is_bounded_and_repeatable(spark):
    df = labelled(spark, 30)
    a, b = language.fit(df, per_language=5), language.fit(df.repartition(7), per_language=5)
    assert (a.family_weights == b.family_weights).all()


def test_held_out_accuracy(spark):
    rows = queries.op4_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = rows.join(truth, "doc_id").where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).head()
    assert found[0] > 0.97 and found[1] > 100
