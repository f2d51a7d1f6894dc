from wardflow.llm import language_id as X

SAID = {
    "en": "the house is near the old river and they were walking there with their friends in the morning",
    "de": "das haus steht nicht weit vom alten fluss und sie gingen dort am morgen mit ihren freunden spazieren",
    "fr": "la maison est près de la vieille rivière et ils marchaient avec leurs amis pendant toute la matinée",
    "es": "la casa está cerca del viejo río y ellos caminaban allí con sus amigos por la mañana temprano siempre",
}


def corpus(spark, n=160):
    rows = []
    for i in range(n):
        language = X.LANGUAGES[i % 4]
        words = SAID[language].split(" ")
        turned = " ".join(words[i % 9 :] + words[: i % 9])
        rows.append((i, turned, language, f"{language}.host{i % 2}.example", 7))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, kept int"


def test_held_out_texts_with_wrong_or_missing_tags(spark):
    extra = [(1000 + i, SAID[l] + ". " + SAID[l], "de" if i % 2 else None, "other", 7) for i, l in enumerate(X.LANGUAGES)]
    out = {r.doc_id: r for r in X.identify_documents(spark.createDataFrame(corpus(spark) + extra, SCHEMA)).collect()}
    assert all(out[i].language == X.LANGUAGES[i % 4] and out[i].kept for i in range(160))
    assert [out[1000 + i].language for i in range(4)] == list(X.LANGUAGES)


def test_other_evidence_decides_what_the_text_leaves_open(spark):
    extra = [(2000, "kk", "es", "es.host0.example", 7), (2001, "qq", None, "fr.host0.example", 7)]
    out = {r.doc_id: r for r in X.identify_documents(spark.createDataFrame(corpus(spark) + extra, SCHEMA)).collect()}
    assert out[2000].language == "es" and out[2001].language == "fr"


def test_rejections_nulls_and_extra_columns(spark):
    odd = [(3000, None, None, None, 7), (3001, "", "en", "x", 7), (3002, "123 !!", "en", "x", 7), (None, SAID["en"], "en", None, 7)]
    docs = spark.createDataFrame(corpus(spark) + odd + [(5, SAID["de"] * 3000, "de", "x", 7)], SCHEMA)
    rows = X.identify_documents(docs).collect()
    assert len(rows) == 165 and {r.doc_id for r in rows if not r.kept} == {3000, 3001, 3002}
    assert {r.language for r in rows if not r.kept} == {"und"}
    kept = X.drop_unidentified(docs)
    assert kept.columns == docs.columns and kept.count() == 162
    assert X.identify_documents(docs.limit(0)).collect() == []


def test_pages_use_markup_and_address(spark):
    rows = [
        (i, f"https://www.{l}{i % 3}.example.{l}/a", f"<html lang='{l}-XX'><script>x</script><p>{t}</p></html>")
        for i, (_, t, l, _, _) in enumerate(corpus(spark, 80))
    ]
    rows.append((500, "http://new.fr/", "<html lang='fr'><p>ok</p></html>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.language for r in X.identify_pages(pages).collect()}
    assert all(found[i] == X.LANGUAGES[i % 4] for i in range(80)) and found[500] == "fr"


def test_documents_in_a_known_language_are_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    judged = X.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert judged.where("kept AND language = lang").count() == docs.count()


# Texts in languages that the corpus does not declare, and random characters.
FOREIGN = {
    "ru": "дом стоит недалеко от старой реки и утром они гуляли там вместе со своими друзьями по берегу",
    "zh": "房子离古老的河流不远他们早上和朋友们一起在那里散步然后回家吃饭看书休息",
    "ar": "البيت قريب من النهر القديم وكانوا يمشون هناك مع أصدقائهم في الصباح الباكر",
    "pl": "dom stoi niedaleko starej rzeki a rano spacerowali tam razem ze swoimi przyjaciółmi wzdłuż brzegu",
    "fi": "talo on lähellä vanhaa jokea ja he kävelivät siellä ystäviensä kanssa varhain aamulla",
    "zz": "xq7vkz jw9pqx zvbkq wqxjz kkvzq pxwqj zzvqk jqxwv bqzkx vwqpz xjkqz qvzwx kzqjv wxqzk",
}


def test_foreign_and_junk_texts_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [(-1 - i, t, l if i % 2 else "de", "hot") for i, (l, t) in enumerate(FOREIGN.items())]
    out = X.identify_documents(docs.union(spark.createDataFrame(odd, docs.schema))).where("doc_id < 0").collect()
    assert len(out) == len(odd) and {(r.language, r.kept) for r in out} == {("und", False)}


def test_numbers_and_keys_are_no_evidence(spark):
    odd = [(3100, "the house 9f3a77c1de0b55aa42 4550997810720808 a8f00e1", "en", "x", 7)]
    out = {r.doc_id: r for r in X.identify_documents(spark.createDataFrame(corpus(spark) + odd, SCHEMA)).collect()}
    assert out[3100].language == "en" and out[3100].kept


def test_a_fifth_language_that_rows_declare_is_a_candidate(spark):
    words = FOREIGN["pl"].split(" ")
    polish = [(5000 + i, " ".join(words[i % 9 :] + words[: i % 9]), "pl-PL", "a.example", 7) for i in range(40)]
    stray = [(6000, FOREIGN["pl"], None, "other", 7), (6001, SAID["de"], "PL", "other", 7)]
    out = {r.doc_id: r for r in X.identify_documents(spark.createDataFrame(corpus(spark) + polish + stray, SCHEMA)).collect()}
    assert all(out[i].language == "pl" and out[i].kept for i in [*range(5000, 5040), 6000]) and out[6001].language == "de"
    assert all(out[i].language == X.LANGUAGES[i % 4] for i in range(160))


def test_tags_are_read_by_their_primary_subtag(spark):
    tags = ["en", "EN-us", "pt_BR", "fil", "fil-PH", "x-klingon", "", None, "e n", " de "]
    rows = spark.createDataFrame([(t,) for t in tags], "t string").select(X.primary_subtag(X.F.col("t")).alias("t")).collect()
    assert [r.t or "" for r in rows] == ["en", "en", "pt", "fil", "fil", "", "", "", "", "de"]


def test_a_corpus_without_declared_languages_is_not_judged(spark):
    out = X.identify_documents(spark.createDataFrame([(1, SAID["en"], None, "a", 7)], SCHEMA)).collect()
    assert [(r.language, r.kept) for r in out] == [("und", False)]


def test_stage_judges_rows_not_ids(spark):
    """A null or shared id rescues no other row."""
    said = SAID["en"]
    rows = [(None, said, "en", "s"), (None, "12 34", "en", "s"), (5, said, "en", "s"), (5, "..", "en", "s"), (6, SAID["de"], "de", "s")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = X.drop_unidentified(docs).collect()
    assert len(out) == 9 and {r.text for r in out} == {said, SAID["de"]}
