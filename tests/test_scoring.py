import re

import pytest
from pyspark.sql import functions as F

import modspark as m
from modspark import defaults
from modspark import fixed_values as V
from modspark.operators.lexicons import count_hits, policy_hits
from modspark.operators.policy import policy_prose
from workload import tables as X


def texts(spark, *rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id INT, text STRING")


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")


def test_language_ranking(spark):
    df = texts(
        spark, "the cat and the dog", "der Hund und die Katze", "12345", "今日はいい天気です。東京", "我不喜欢这个世界",
        "the der und",
    )
    got = {r["doc_id"]: r["languages"] for r in m.detect_language(df).collect()}
    assert [got[i][0]["lang"] for i in range(6)] == ["en", "de", "und", "ja", "zh", "de"]
    assert [(l["lang"], round(l["score"], 3)) for l in got[5]] == [("de", 0.667), ("en", 0.333)]
    assert got[2][0]["score"] == 0.0


def test_language_ties_go_by_name_and_floor_applies(spark):
    ranked = m.detect_language(texts(spark, "der the"))
    assert m.top_language(ranked).head()["lang"] == "de"
    assert m.top_language(ranked, min_score=0.6).head()["lang"] == "und"


def test_resolve_english_with_and_without_broadcast(spark, monkeypatch):
    df = spark.createDataFrame(
        [(1, "hello", "en"), (2, "hallo", "de"), (3, "bonjour", "fr"), (4, "hallo", "de"), (5, "x", None),
         (6, None, "de"), (7, None, "en")],
        "doc_id INT, text STRING, lang STRING")
    t = df.filter("text = 'hallo'").select(F.sha2("text", 256).alias("text_hash"), F.lit("hello").alias("english"))
    want = {1: ("hello", False), 2: ("hello", False), 3: (None, True), 4: ("hello", False), 5: (None, True),
            6: (None, True), 7: (None, False)}

    def got(frame):
        return {r["doc_id"]: (r["english"], r["pending"]) for r in frame.collect()}

    assert got(m.resolve_english(df, t)) == want
    monkeypatch.setattr("modspark.operators.scoring.is_small", lambda *_: False)
    assert got(m.resolve_english(df, t, spread_by=["doc_id"])) == want
    assert got(m.resolve_english(df)) == {
        1: ("hello", False), 7: (None, False), **{i: (None, True) for i in (2, 3, 4, 5, 6)}}


def test_sentiment_formula(spark):
    df = m.with_tokens(texts(spark, "good good bad", "bad", "good", "good bad", "nothing here", "").withColumn("lang", F.lit("en")))
    got = {r["doc_id"]: r for r in m.sentiment(df).collect()}
    assert [got[i]["sentiment"] for i in range(6)] == ["MIXED", "NEGATIVE", "POSITIVE", "MIXED", "NEUTRAL", "NEUTRAL"]
    assert tuple(got[0]["sentiment_score"]) == (0.25, 0.0, 0.25, 0.5)
    assert all(abs(sum(r["sentiment_score"]) - 1) < 1e-12 for r in got.values())


def test_lexicon_rows_are_scoped_by_language(spark):
    df = m.with_tokens(texts(spark, "beer").crossJoin(spark.createDataFrame([("en",), ("de",)], "lang STRING")))
    got = {r["lang"]: r["toxicity"] for r in m.toxicity(df, [("insult", "beer", "en")]).collect()}
    assert got == {"en": 0.5, "de": 0.0}


def test_negative_flag(spark):
    df = m.with_tokens(texts(spark, "bad", "good").withColumn("lang", F.lit("en")))
    got = [(r["sentiment_negative"], r["negative_score"]) for r in m.negative_flag(m.sentiment(df)).orderBy("doc_id").collect()]
    assert got == [(True, 0.5), (False, 0.0)]


def test_pii_of_an_english_line(spark):
    text = "Hello! My name is Clara, write to clara9@example.com.\n"
    got = [(e["type"], e["begin"], e["end"]) for e in m.pii_entities(texts(spark, text)).collect()]
    assert got == [("NAME", 18, 23), ("EMAIL", 34, 52)]
    assert text[18:23] == "Clara" and text[34:52] == "clara9@example.com"


def test_pii_of_a_chinese_line_counts_characters(spark):
    text = "大家好，我叫李小花，刚满14岁。邮箱55@example.com，手机16500000222。"
    found = [(e["type"], text[e["begin"]:e["end"]]) for e in m.pii_entities(texts(spark, text)).collect()]
    assert found == [("NAME", "李小花"), ("AGE", "14"), ("EMAIL", "55@example.com"), ("PHONE", "16500000222")]


def test_pii_borders_and_neighbours(spark):
    text = "1234567890123456 6543210987654321 12345678901234567 10.0.0.1 16500000222 16500000223 +1 (415) 555-2671, I am 30 years old"
    found = [(e["type"], text[e["begin"]:e["end"]]) for e in m.pii_entities(texts(spark, text)).collect()]
    assert found == [
        ("CREDIT_DEBIT_NUMBER", "1234567890123456"), ("CREDIT_DEBIT_NUMBER", "6543210987654321"),
        ("IP_ADDRESS", "10.0.0.1"), ("PHONE", "16500000222"), ("PHONE", "16500000223"),
        ("PHONE", "+1 (415) 555-2671"), ("AGE", "30 years")]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_pii_offsets_of_many_matches(spark, n):
    import random

    r = random.Random(n)
    parts = [("x" * r.randint(1, 9) + " ", f"{r.randint(1, 99)}.{r.randint(0, 9)}.0.{k % 250}") for k in range(n)]
    text = "é " + " ".join(a + b for a, b in parts)
    got = m.with_pii(texts(spark, text)).head()["pii"]
    assert [text[e["begin"]:e["end"]] for e in got] == [b for _, b in parts]


def test_pii_takes_time_in_proportion_to_the_matches(spark):
    import time

    def seconds(n):
        df = spark.range(1).select(F.repeat(F.lit("a 1.2.3.4 "), n).alias("text"))
        start = time.perf_counter()
        assert m.with_pii(df).select(F.size("pii")).head()[0] == n
        return time.perf_counter() - start

    seconds(100)
    few, many = seconds(32_000), seconds(320_000)
    assert many < 15 * few + 2


def test_a_trie_of_many_phrases_in_the_row(spark):
    """More rows than stand in a plan: no join, no shuffle, no written table."""
    policy = [(i % 7, f"c{i % 7}", f"w{chr(97 + i % 26)} x{chr(97 + i // 26 % 26)} y{chr(97 + i // 676)}", "*") for i in range(6000)]
    rows = [(k, f"wa xa ya wb, xb ya {'wa xa ' * k}ya", "en") for k in range(5)] + [(9, None, None)]
    df = m.with_tokens(spark.createDataFrame(rows, "doc_id INT, text STRING, lang STRING"))
    hit = m.policy_verdict(df, policy)
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "parquet" not in plan
    got = {r["doc_id"]: (r["flag"], r["reason"]) for r in hit.collect()}
    assert got[0] == (True, "wa xa ya, wb xb ya") and got[3] == (True, "wa xa ya, wb xb ya") and got[9] == (False, "")


def test_the_classifier_scores_in_the_row(spark):
    train = spark.createDataFrame([("good day", "safe"), ("bad bad", "bad")], "text STRING, label STRING")
    df = spark.createDataFrame([(1, "good", "en"), (2, None, "en"), (3, "unseen", "en")], "doc_id INT, text STRING, lang STRING")
    model = m.fit_classifier(train)
    for scored in (m.prompt_safety(df, model), m.analyze_text(df, model, lang="lang")):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        assert {r["doc_id"]: r["prompt_class"] for r in scored.collect()} == {1: "safe", 2: "safe", 3: "safe"}


def test_pii_offsets_cut_out_the_match_in_whole_corpus(spark, sf):
    d = documents(spark, sf).withColumn("t", F.col("text"))
    for r in m.pii_entities(d, ids=["doc_id", "t"]).collect():
        hit = r["t"][r["begin"]:r["end"]]
        assert {"EMAIL": "@" in hit, "IP_ADDRESS": hit.count(".") == 3, "CREDIT_DEBIT_NUMBER": len(hit) == 16,
                "PHONE": len(hit) > 10}.get(r["type"], True), r


def test_first_pii(spark):
    got = m.first_pii(m.with_pii(texts(spark, "a@b.com 10.0.0.1", "none"))).orderBy("doc_id").collect()
    assert [(r["pii_type"], r["pii_score"]) for r in got] == [("EMAIL", 1.0), (None, None)]


PLANS = [{}, {"inline_limit": 0}, {"inline_limit": 0, "trie_limit": 0}]


@pytest.mark.parametrize("limits", PLANS)
def test_hits_agree_with_brute_force_in_all_plans(spark, sf, limits):
    df = m.with_tokens(documents(spark, sf))
    # A word listed twice, for '*' and for a language, counts once.
    lexicon = [*X.TOXIC, *X.SENTIMENTS, ("insult", "idiot", "en"), ("positive", "the", "*"), ("positive", "the", "en")]
    classes = ["insult", "profanity", "positive", "negative"]
    got = {
        r["doc_id"]: tuple(r[f"n_{c}"] for c in classes)
        for r in count_hits(df, lexicon, classes, id_col="doc_id", prefix="n_", **limits).collect()
    }
    for r in documents(spark, sf).collect():
        words = [w for w in re.split(r"[^\w]|[\d_]", r["text"].lower()) if w]
        for i, c in enumerate(classes):
            wanted = {w for cls, w, lang in lexicon if cls == c and lang in ("*", r["lang"])}
            assert got[r["doc_id"]][i] == sum(w in wanted for w in words)


@pytest.mark.parametrize("limits", PLANS)
def test_policy_hits_agree_with_brute_force_in_all_plans(spark, sf, limits):
    df = m.with_tokens(documents(spark, sf))
    common = m.with_tokens(documents(spark, sf)).filter("size(_tokens) > 9").orderBy("doc_id").head()
    policy = [*X.PHRASES, (4, "Visually Disturbing", "la", "*"), (4, "Visually Disturbing", "la", "fr"),
              (2, "Suggestive", " ".join(common["_tokens"][2:8]), "*")]
    rows = policy_hits(df, policy, id_col="doc_id", **limits).collect()
    assert any(r["policy_matched"] for r in rows)
    for r in rows:
        words = r["_tokens"]
        applies = {(n, p) for n, _, p, lang in policy if lang in ("*", r["lang"])}
        want, seen = {}, set()
        for number, phrase in applies:
            parts = phrase.split(" ")
            n = sum(words[i:i + len(parts)] == parts for i in range(len(words) - len(parts) + 1))
            if n:
                want[number] = want.get(number, 0) + n
                seen.add(phrase)
        assert {c["category_no"]: c["n"] for c in r["policy_counts"]} == want
        assert r["policy_matched"] == sorted(seen)


def test_overlapping_and_repeated_phrases_all_count(spark):
    df = m.with_tokens(texts(spark, "graphic male nudity, pills pills a b a b a", "").withColumn("lang", F.lit("en")))
    policy = [*defaults.POLICY_PHRASES, (11, "Own", "a b a", "*")]
    first, empty = policy_hits(df, policy).orderBy("doc_id").collect()
    assert {c["category"]: c["n"] for c in first["policy_counts"]} == {"Explicit Nudity": 2, "Drugs": 2, "Own": 2}
    assert empty["policy_counts"] == [] and empty["policy_matched"] == []


def test_verdict_tie_goes_by_policy_order(spark):
    df = m.with_tokens(texts(spark, "gambling smoking", "hello").withColumn("lang", F.lit("en")))
    a, b = m.policy_verdict(df).orderBy("doc_id").collect()
    assert (a["flag"], a["category"], a["reason"]) == (True, "Tobacco", "gambling, smoking")
    assert (b["flag"], b["category"], b["reason"]) == (False, "", "")


def test_stems_flag_prose_and_unjudged_is_null(spark):
    hostile = "I hate this world, this world confuses me, so I want to destroy the earth."
    rows = [(1, hostile, "en"), (2, "我不喜欢这个世界，我要毁灭世界和地球！", "zh"), (3, "A stable, friendly place.", "en"),
            (4, "Это текст.", "ru"), (5, "murdering killers kill", None), (6, None, "en"), (7, "pills, then a killing. Pills!", "en"), (8, "", "en")]
    df = m.with_tokens(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    verdict = m.policy_verdict(df, stems=defaults.POLICY_STEMS, null_unjudged="text")
    got = {r["doc_id"]: tuple(r)[1:] for r in m.flag_decision(verdict).select("doc_id", "flag", "category", "reason", "decision").collect()}
    assert got == {
        1: (True, "Violence", "destroy", V.DECISION_REVIEW), 2: (True, "Violence", "毁灭", V.DECISION_REVIEW),
        3: (False, "", "", V.DECISION_PASS), 4: (None, None, None, V.DECISION_REVIEW), 5: (None, None, None, V.DECISION_REVIEW),
        6: (None, None, None, V.DECISION_REVIEW), 7: (True, "Drugs", "kill, pills", V.DECISION_REVIEW), 8: (False, "", "", V.DECISION_PASS)}
    # Stems for any language, in a row whose language is missing; regular expression signs are letters like others.
    own = [(3, "Violence", "kill", "*"), (3, "Violence", "killer", "*"), (11, "Own", "a.c", "*")]
    r = m.policy_verdict(df.filter("doc_id = 5"), [], stems=own, null_unjudged="text").head()
    assert (r["flag"], r["category"], r["reason"]) == (True, "Violence", "kill, killer")
    plain = m.policy_verdict(df).filter("doc_id in (1, 4, 6)").collect()
    assert all(r["flag"] is False for r in plain)
    assert m.policy_verdict(df.limit(0), stems=own, null_unjudged=True).count() == 0


def test_judged_languages_from_a_table_in_all_plans(spark):
    df = spark.createDataFrame([(1, "a", "en"), (2, "b", "xx"), (3, None, "en"), (4, "d", None)], "doc_id int, text string, lang string")
    table = spark.createDataFrame([(1, "c", "p", "en"), (1, "c", "q", "l1"), (1, "c", "q", "l2")], "category_no int, category string, phrase string, lang string")
    for limit in (10, 1):
        got = m.with_judged(df, table, [], "text", inline_limit=limit).orderBy("doc_id")
        assert [r["judged"] for r in got.collect()] == [True, False, False, False]
        every = m.with_judged(df, table.union(spark.createDataFrame([(1, "c", "z", "*")], table.schema)), [], "text", inline_limit=limit)
        assert sorted(r["doc_id"] for r in every.filter("judged").collect()) == [1, 2, 4]


def test_child_safety_degrees(spark):
    df = m.with_tokens(texts(spark, "", "pills", "pills " * 3, "pills " * 6).withColumn("lang", F.lit("en")))
    got = [(r["result"], r["degree"]) for r in m.child_safety(df).orderBy("doc_id").collect()]
    assert got == [("Safe", "None"), ("Unsafe", "Low"), ("Unsafe", "Med"), ("Unsafe", "High")]


def test_policy_prose_and_rows_agree(spark):
    prose = spark.createDataFrame([(policy_prose(),)], "policy STRING")
    parsed = m.parse_policy(prose).collect()
    assert sorted(map(tuple, parsed)) == sorted(map(tuple, m.load_policy(spark).collect()))
    assert len({r["category"] for r in parsed}) == len(V.POLICY) == 10
    phrases = m.policy_phrases(m.load_policy(spark)).collect()
    assert sorted((r[0], r[1], r[2], r[3]) for r in phrases) == sorted(defaults.POLICY_PHRASES)


def test_parse_policy_with_a_doubled_verb(spark):
    df = spark.createDataFrame([("  7. Tobacco: it contains contain Tobacco Products and Smoking.\n",)], "policy STRING")
    assert [r["subcategory"] for r in m.parse_policy(df).collect()] == ["Tobacco Products", "Smoking"]


def test_prompts_leave_braces_of_the_text_alone(spark):
    out = m.render_prompts(texts(spark, "a {policy} {text} b")).head()["prompt"]
    assert "a {policy} {text} b" in out and "1. Explicit Nudity" in out and '"flag": "xxx"' in out


def test_json_verdicts(spark):
    replies = [
        ' {\n  "flag": "false", \n  "category": "",\n  "reason": "fine"\n}',
        ' {"flag": "yes", "category": "Violence", "reason": "a line\n break"} thanks',
        "No idea.", '{"flag": "maybe"}', '{"flag": ', None, '{"flag": "Unsafe"}',
    ]
    got = m.parse_json_verdict(texts(spark, *replies), "text").orderBy("doc_id").collect()
    assert [r["flag"] for r in got] == [False, True, None, None, None, None, True]
    assert [r["parse_ok"] for r in got] == [True, True, False, True, False, False, True]
    assert got[1]["reason"] == "a line\n break"


def test_line_verdicts(spark):
    reply = 'Intro: dropped\nResult:"Unsafe"\nDegree of harm: "High"\nExplanation\na: b: c\nResult: "Safe"'
    df = texts(spark, reply, "Result: x", "")
    got = m.parse_line_verdict(df, "text").orderBy("doc_id").collect()
    assert got[0]["verdict"] == {"Result": '"Safe"', "Degree of harm": '"High"'}
    assert got[1]["verdict"] == {"Result": "x"} and got[2]["verdict"] == {}
    assert m.parse_line_verdict(df, "text", unquote=True).orderBy("doc_id").head()["verdict"]["Result"] == "Safe"


def test_classifier_agrees_with_the_library_model(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer

    train = spark.createDataFrame(
        [(0, "safe calm words", 0.0), (1, "calm day", 0.0), (2, "attack now", 1.0), (3, "attack the calm day", 1.0)],
        "doc_id INT, text STRING, label DOUBLE")
    model = m.fit_classifier(train.withColumn("label", F.col("label").cast("int")))
    got = {r["doc_id"]: r["prompt_class"] for r in m.prompt_safety(train, model).collect()}
    tok = m.with_tokens(train)
    counts = CountVectorizer(inputCol="_tokens", outputCol="features").fit(tok).transform(tok)
    fitted = NaiveBayes(smoothing=1.0).fit(counts).transform(counts)
    assert got == {r["doc_id"]: str(int(r["prediction"])) for r in fitted.collect()}


def test_classifier_saved_and_with_shuffle_join(spark, sf, monkeypatch, tmp_path):
    d = documents(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.join(d, "doc_id").select("text", F.col("toxic").alias("label"))
    model = m.fit_classifier(train, save_to=str(tmp_path / "model"))
    small = m.prompt_safety(d, model).select("doc_id", "prompt_class", "prompt_log_score").orderBy("doc_id").collect()
    monkeypatch.setattr("modspark.operators.classifier.BROADCAST_BYTES", 0)
    large = m.prompt_safety(d, model).select("doc_id", "prompt_class", "prompt_log_score").orderBy("doc_id").collect()
    assert small == large and len(small) == d.count()
    assert model.classes.agg(F.sum("n_docs")).head()[0] == train.count()


def test_a_large_model_meets_the_words_of_blocks(spark, monkeypatch):
    from modspark.operators import classifier

    texts = ["good day", None, "bad bad day", "", "unknown", "good good good"] * 40
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING").repartition(2, "doc_id")
    model = m.fit_classifier(spark.createDataFrame([("good day", "safe"), ("bad bad", "bad")], "text STRING, label STRING"))
    columns = ["doc_id", "prompt_class", "prompt_log_score"]
    want = m.prompt_safety(rows, model).select(*columns).orderBy("doc_id").collect()
    keyed = rows.select(F.col("doc_id").alias("_rid"), "text")
    blocks = classifier.word_blocks(keyed, "text")
    # A word is moved once for a block, however many texts have it.
    assert blocks.agg(F.sum(F.size("words"))).head()[0] <= 4 * blocks.count() and blocks.count() <= 2
    monkeypatch.setattr(classifier, "BROADCAST_BYTES", 0)
    for limit in (classifier.BLOCK_WORDS, 7):
        monkeypatch.setattr(classifier, "BLOCK_WORDS", limit)
        assert m.prompt_safety(rows, model).select(*columns).orderBy("doc_id").collect() == want
    cut = classifier.word_blocks(keyed, "text", 7)
    assert cut.count() > 20 and cut.select(F.explode("rids")).distinct().count() == len(texts)
    assert cut.agg(F.max(F.size("words"))).head()[0] <= 4


def test_phrases_are_formed_only_at_their_first_words(spark, monkeypatch):
    from modspark.operators import lexicons

    texts = ["a b c d " * 50, "b c", "", None, "x a", "a b a b c"]
    d = m.with_tokens(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id INT, text STRING, lang STRING"))
    policy = [(1, "One", "a b c", "*"), (2, "Two", "b", "en"), (3, "Three", "a", "de"), (3, "Three", "x a", "*"), (4, "Four", None, "*")]
    columns = ["doc_id", "flag", "category", "reason"]
    want = m.policy_verdict(d, [p for p in policy if p[2]], lang="lang").select(*columns).orderBy("doc_id").collect()
    joined, join = [], lexicons.lookup_join
    monkeypatch.setattr(lexicons, "lookup_join", lambda many, *a: joined.append(many.count()) or join(many, *a))
    frame = spark.createDataFrame(policy, "category_no INT, category STRING, phrase STRING, lang STRING")
    got = m.policy_verdict(d, frame, lang="lang", inline_limit=0, trie_limit=0).select(*columns).orderBy("doc_id").collect()
    assert got == want and joined[0] == 200 + 2 + 2 + 5
    # Of the 209 places 50 + 50, 1, 2 and 2 + 2 begin with a, b or x, and at most three lengths are tried there.
    assert joined[1] <= 3 * 107


def test_missing_text_scores_as_empty(spark):
    df = spark.createDataFrame([(1, None, "en")], "doc_id INT, text STRING, lang STRING")
    r = m.moderate_text(df, lang="lang").head()
    assert (r["flag"], r["category"], r["sentiment"], r["pii"]) == (False, "", "NEUTRAL", [])
    assert m.top_language(m.detect_language(df.drop("lang"))).head()["lang"] == "und"


def test_results_do_not_depend_on_ids_or_lexicon_size(spark):
    df = spark.createDataFrame([(1, "smoking", "en"), (1, "hello", "en"), (None, "smoking", "en")], "doc_id INT, text STRING, lang STRING")
    d = m.with_tokens(df)
    for limits in PLANS:
        rows = m.policy_verdict(d, [(7, "Tobacco", "smoking", "en")], **limits).collect()
        assert sorted((str(r["doc_id"]), r["text"], r["flag"]) for r in rows) == [
            ("1", "hello", False), ("1", "smoking", True), ("None", "smoking", True)]
        rows = m.toxicity(d, [("insult", "hello", "*")], **limits).collect()
        assert sorted((r["text"], r["toxicity"]) for r in rows) == [("hello", 0.5), ("smoking", 0.0), ("smoking", 0.0)]
    train = spark.createDataFrame([("good day", "safe"), ("bad bad", "bad")], "text STRING, label STRING")
    three = spark.createDataFrame([(1, "good"), (1, "bad bad"), (None, "bad bad")], "doc_id INT, text STRING")
    got = m.prompt_safety(three, m.fit_classifier(train)).collect()
    assert sorted((r["text"], r["prompt_class"]) for r in got) == [("bad bad", "bad"), ("bad bad", "bad"), ("good", "safe")]


def test_marks_belong_to_words(spark):
    r = m.with_tokens(spark.createDataFrame([("हिन्दी cafe\u0301 x",)], "text STRING")).head()
    assert r["_tokens"] == ["हिन्दी", "cafe\u0301", "x"]


def test_rows_from_files_are_known_without_a_copy(spark, sf, monkeypatch):
    from modspark.operators import rows

    d = m.with_tokens(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").filter("doc_id % 3 = 0"))
    want = m.toxicity(d, X.TOXIC).select("doc_id", "toxicity").orderBy("doc_id").collect()
    monkeypatch.setattr(rows, "settle", lambda _: pytest.fail("the rows were written"))
    known = rows.with_row_id(d)
    assert known.select("_rid").distinct().count() == d.count()
    got = m.toxicity(d, X.TOXIC, inline_limit=0, trie_limit=0)
    assert got.columns == [*d.columns, "toxicity_labels", "toxicity"]
    assert got.select("doc_id", "toxicity").orderBy("doc_id").collect() == want
    monkeypatch.undo()
    for other in (d.union(d), d.select("doc_id", F.explode(F.array(F.lit(1), F.lit(2)))), spark.range(5), d.groupBy("lang").count(),
                  d.select("doc_id").crossJoin(spark.range(2))):
        numbered = rows.with_row_id(other)
        assert numbered.select("_rid").distinct().count() == other.count()
