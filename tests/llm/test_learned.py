import random

import numpy as np
from pyspark.sql import functions as F

from aval.llm import language_id, quality_rules, toxicity


def test_rules_are_learned_and_keep_clean_texts(spark):
    random.seed(1)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [f"word{random.randrange(400)}" + ("##" if bad and random.random() < 0.6 else "") for _ in range(60)]
        rows.append((i, " ".join(words)))
        labels += [(i, 0 if bad else 1)] * (1 + i % 2)
    table = spark.createDataFrame(rows + [(9_000, None)], "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 0), (1, None), (2, 7)], "doc_id long, quality int")
    counts = quality_rules.text_statistics(table, ["doc_id"])
    learned = quality_rules.learn_rules(counts, known)
    assert learned.rules and " > " in str(learned)
    kept = {r.doc_id: r.kept for r in counts.select("doc_id", learned.verdict().alias("kept")).collect()}
    assert all(kept[i] == (i % 4 != 0) for i in range(600)) and kept[9_000]
    assert quality_rules.learn_rules(counts, known.limit(0)).rules == ()
    assert quality_rules.learn_rules(counts.limit(0), known).rules == ()


def test_languages(spark, docs, empty):
    random.seed(2)
    letters = {"aa": "abcde", "bb": "fghij"}
    def text(lang):
        return " ".join("".join(random.choices(letters[lang], k=4)) for _ in range(30))
    rows = [(i, lang, text(lang)) for i, lang in enumerate(["aa", "bb"] * 60)]
    table = spark.createDataFrame(rows + [(500, None, "abcd"), (501, "aa", None)], "doc_id long, lang string, text string")
    model = language_id.learn_languages(table)
    fresh = spark.createDataFrame([(i, text(lang)) for i, (_, lang, _) in enumerate(rows)] + [(900, None), (901, "12 ##"), (902, "漢字"), (903, "1² ½ _")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.predict_languages(fresh, model, ["doc_id"]).collect()}
    assert all(got[i].lang_pred == lang for i, (_, lang, _) in enumerate(rows))
    assert got[900].lang_pred == got[901].lang_pred == got[903].lang_pred == "und" and got[902].lang_pred in ("aa", "bb")
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language_id.learn_languages(empty)
    assert {r.lang_pred for r in language_id.predict_languages(docs, nothing, ["doc_id"]).collect()} == {"und"}


def test_language_sample_is_bounded_without_ids_and_counts_copies_once(spark):
    # A third of the rows has no id, a third is one row over and over.
    rows = [(None, f"alpha beta word{i}", "aa") for i in range(400)] + [(7, "same old text", "aa")] * 400 + [
        (i, f"gamma delta term{i}", "bb") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn_languages(table, docs_per_language=100)
    assert model.langs == ["aa", "bb"]
    predict = model.predictor()
    assert predict("beta alpha")[0] == "aa" and predict("delta gamma")[0] == "bb"
    whole = language_id.learn_languages(table, docs_per_language=10_000)
    assert {"alpha", "beta", "word", "gamma", "delta", "term"} == set(whole.words)  # the others are seen once
    again = language_id.learn_languages(table.repartition(5), docs_per_language=100)
    assert again.words == model.words and np.array_equal(again.gram_scores, model.gram_scores)


def test_every_language_keeps_its_tokens_and_reads_those_of_others(spark):
    rows = [(i, "big big big both both", "aa") for i in range(50)] + [(100, "small small both", "bb")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn_languages(table, words_per_language=2, grams_per_language=5)
    assert set(model.words) == {"big", "both", "small"}
    column = model.langs.index("bb")
    # Seen once in bb, which is too few to propose the word there, but it counts.
    assert model.word_scores[model.words["both"], column] > model.word_scores[model.words["big"], column]


def test_rules_count_an_id_once(spark):
    text = "some words of a text that has more than ten words in all of it"
    docs = spark.createDataFrame(
        [(1, text)] * 300 + [(2, text + " ###")] * 300 + [(i, text + (" ### ### ###" if i % 2 else "")) for i in range(3, 63)],
        "doc_id long, text string")
    labels = spark.range(1, 63).selectExpr("id as doc_id", "if(id % 2 = 1, 0, 1) as quality")
    counts = quality_rules.text_statistics(docs, ["doc_id"])
    first = quality_rules.learn_rules(counts, labels, sample_rows=62)
    assert first == quality_rules.learn_rules(counts.dropDuplicates(), labels, sample_rows=62)
    assert first.rules


def test_shorter_grams_score_unseen_words():
    model = language_id.LanguageModel(["a", "b"], {}, {"ab": 0, "z": 1}, np.zeros((0, 2)), np.array([[2.0, -2.0], [-1.0, 1.0]]))
    assert model.unseen("ab").tolist() == [2.0, -2.0] and model.unseen("z")[1] == 1.0 and not model.unseen("q").any()


def test_toxicity_from_positive_and_unlabelled(spark):
    random.seed(4)
    rows, labels = [], []
    for i in range(900):
        words = [f"w{random.randrange(200)}" for _ in range(40)]
        if i % 6 == 0:
            words[random.randrange(40)] = random.choice(["nasty", "vilelike", "vileness"])
        rows.append((i, " ".join(words).replace("w1", "ha")))
        if i % 3 == 0:
            labels.append((i, int(i % 6 == 0)))
    table = spark.createDataFrame(rows + [(5_000, None), (5_001, "")] + rows[:2], "doc_id long, text string")
    known = spark.createDataFrame(labels + labels[:5] + [(None, 1), (7, None), (8, 9)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(table, known, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(table, model, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == (i % 6 == 0) for i in range(900))
    assert got[5_000] == got[5_001] < 0.5
    none = toxicity.learn_toxicity(table, known.where("toxic = 0"), F.lit(True))
    assert none.weights == {} and max(r.score for r in toxicity.score_toxicity(table, none, ["doc_id"]).collect()) < 0.5


def test_negative_risk_stays_non_negative():
    rng = np.random.default_rng(0)
    positive = np.r_[np.ones(30, bool), np.zeros(300, bool)]
    rows = np.repeat(np.arange(330), 5)
    columns = rng.integers(0, 2_000, len(rows))
    weights, bias = toxicity.fit_nnpu(rows, columns, positive, 2_000, 0.1)
    margin = np.bincount(rows, weights[columns], 330) + bias
    loss = 1 / (1 + np.exp(-margin))
    assert loss[~positive].mean() - 0.1 * loss[positive].mean() > -0.02


def toxic_table(spark, seed=4, n=900):
    random.seed(seed)
    rows = []
    for i in range(n):
        words = [f"w{random.randrange(200)}" for _ in range(40)]
        if i % 6 == 0:
            words[random.randrange(40)] = random.choice(["nasty", "vilelike", "vileness"])
        rows.append((i, " ".join(words)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_toxicity_without_a_single_negative(spark):
    """Confirmed toxic labels alone give the prior, and the same verdicts."""
    _, table = toxic_table(spark)
    known = spark.createDataFrame([(i, 1) for i in range(0, 900, 18)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(table, known, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(table, model, ["doc_id"]).collect()}
    assert sum(got[i] >= 0.5 for i in range(0, 900, 6)) >= 0.9 * 150
    assert sum(got[i] >= 0.5 for i in range(900) if i % 6) <= 0.01 * 750


def test_the_prior_is_estimated(spark):
    rng = np.random.default_rng(8)
    for share in (0.05, 0.2, 0.5):
        toxic = np.r_[np.ones(400, bool), rng.random(3_000) < share]
        positive = np.r_[np.ones(400, bool), np.zeros(3_000, bool)]
        pairs = [(i, f) for i, t in enumerate(toxic) for f in range(10) if rng.random() < (0.35 if t else 0.01)]
        rows, columns = np.array(pairs).T
        assert abs(toxicity.estimate_prior(rows, columns, positive, 10) - share) < 0.05


def test_the_labelled_share_is_an_option(spark):
    _, table = toxic_table(spark)
    known = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(0, 900, 3)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(table, known, F.lit(True), toxicity.LABELLED_SHARE)
    assert model.weights["nasty"] > 0
    assert toxicity.learn_toxicity(table, known, F.lit(True), 0.17).weights["nasty"] > 0


def test_toxicity_is_repeatable_where_ids_repeat(spark):
    rows, table = toxic_table(spark)
    known = spark.createDataFrame([(i, 1) for i in range(0, 900, 6)], "doc_id long, toxic int")
    more = spark.createDataFrame([(i, f"other {t}") for i, t in rows[:200]], "doc_id long, text string")
    one = toxicity.learn_toxicity(table.union(more).repartition(7), known, F.lit(True))
    two = toxicity.learn_toxicity(more.union(table).repartition(3), known, F.lit(True))
    assert one == two


def test_one_step_of_the_fit_follows_the_plain_risk():
    """The first step of Adam goes against the sign of the risk's gradient, taken by differences."""
    rng = np.random.default_rng(2)
    x = rng.random((60, 6)) < 0.4
    positive, prior, rate = np.arange(60) < 15, 0.3, 0.05
    rows, columns = np.nonzero(x)

    def risk(theta):
        loss_as_one = 1 / (1 + np.exp(x @ theta[:-1] + theta[-1]))
        negative = (1 - loss_as_one)[~positive].mean() - prior * (1 - loss_as_one)[positive].mean()
        return prior * loss_as_one[positive].mean() + max(0, negative)

    zero, step = np.zeros(7), 1e-6
    gradient = np.array([(risk(zero + step * e) - risk(zero - step * e)) / (2 * step) for e in np.eye(7)])
    weights, bias = toxicity.fit_nnpu(rows, columns, positive, 6, prior, steps=1, rate=rate)
    wanted = -rate * np.sign(gradient)
    clear = np.abs(gradient[:-1]) > 1e-4
    assert clear.sum() >= 4 and np.isclose(bias, wanted[-1], atol=1e-5)
    assert np.allclose(weights[clear], np.maximum(wanted[:-1], 0)[clear], atol=1e-5)
