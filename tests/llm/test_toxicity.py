from __future__ import annotations

import math
import random

import pytest
from lossmill.llm.queries import toxic_lexicon
from lossmill.llm.toxicity import Lexicon, Matcher, fold, learn_lexicon, with_toxicity

WORDS = [a + b + c for a in "bdfgk" for b in "aeiou" for c in ["n", "ral", "sit"]]


def test_fold():
    assert fold("An IDI0T, m0r0n! 12 3") == " an idiot  moron  12 3 ".replace("12 3", "    ")
    assert fold("ідіот") == " idiot "
    assert fold("ｉｄｉｏｔ") == " idiot "
    assert fold("cl@wn a@ $tupid") == " clawn a   tupid "
    assert fold("éß") == " éß "
    assert fold(None) == fold("") == "  "


def test_matches_weights_and_exceptions():
    lexicon = Lexicon({" bad": 2.0, " badger ": 5.0, " ill ": 1.0}, (" not bad ",), (-2.0, 1.0, 1.0))
    matcher = Matcher(lexicon)

    def found(text):
        return [e for _, e in matcher.matches(fold(text))]

    assert found("Badger, baddest. ILLness 1ll") == [" badger ", " bad", " ill "]
    assert found("i11 ill") == [" ill "]
    assert found("not bad but not b4d, bad") == [" bad"]
    clean, _, none = matcher.score("good")
    toxic, _, some = matcher.score("bad " * 3 + "good")
    assert clean < toxic
    assert (none, some) == ([], ["bad"])
    longer, _, _ = matcher.score("bad " * 3 + "good " * 500)
    assert clean < longer < toxic


def corpus(seed, n):
    """Texts; a third has a written-over insult or a word of an insulting stem."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = rng.choices(WORDS, k=rng.randint(20, 60))
        toxic = k % 3 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(
                ["zidiot", "zid10t", "Z1diot", "vexu" + rng.choice(WORDS)]
            )
        elif k % 3 == 1:
            at = rng.randrange(len(words) - 1)
            words[at : at + 2] = ["dear", "zidiot"]
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_learns_entries_stems_and_exceptions(spark):
    rows = corpus(1, 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    lexicon = learn_lexicon(docs.select("doc_id", "text"), labels)
    assert " dear zidiot " in lexicon.exceptions
    assert any(e.startswith(" vexu") for e in lexicon.weights)
    fresh = spark.createDataFrame(corpus(2, 300), "doc_id long, text string, toxic int")
    got = with_toxicity(fresh, lexicon).select("toxic", "toxicity.score").collect()
    assert all((r.score >= 0.3) == bool(r.toxic) for r in got)


def test_near_copies_leave_no_entry_out(spark):
    """One long toxic text in many nearly equal copies has over 2,000 starts of its own."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    long = ["".join(rng.choices(letters, k=9)) for _ in range(500)]
    rows = []
    for k in range(900):
        words = rng.choices(WORDS, k=30)
        if k % 9 == 0:
            words = list(long)
            for at in rng.sample(range(len(long)), 3):
                words[at] = "".join(rng.choices(letters, k=9))
        elif k % 9 == 3:
            words[4] = "zidiot"
        rows.append((k, " ".join(words), int(k % 9 in (0, 3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = learn_lexicon(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert any(e.startswith(" zid") for e in lexicon.weights)
    assert with_toxicity(docs, lexicon).where("toxic = 1 and toxicity.weight = 0").isEmpty()


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "vile", "x"), (1, "vile", "x"), (None, None, None), (2, "", "x"), (3, "a " * 300_000, "x")],
        "doc_id long, text string, toxicity string",
    )
    lexicon = Lexicon({" vile ": 4.0}, (), (-4.0, 2.0, 1.0))
    got = [(r.doc_id, round(r.toxicity.score, 3)) for r in with_toxicity(docs, lexicon).collect()]
    assert got[0] == got[1]
    assert got[0][1] > 0.5
    assert {s for _, s in got[2:]} == {0.018}
    assert with_toxicity(docs.limit(0), lexicon).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert learn_lexicon(docs, none).weights == {}
    assert with_toxicity(docs, learn_lexicon(docs, none)).where("toxicity.score > 0").count() == 0
    one_sided = spark.createDataFrame([(1, 1), (1, None), (None, 0)], "doc_id long, toxic int")
    assert with_toxicity(docs, learn_lexicon(docs, one_sided)).first().toxicity.score == 1


def test_held_out_accuracy(query, spark):
    sf_dir = "/root/testdata/sf0.1"  # the small tables hold too few labels
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    got = query("op3_toxicity", sf_dir).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.score for r in got if r.toxic]
    clean = [r.score for r in got if not r.toxic]
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert wins / (len(toxic) * len(clean)) > 0.8


@pytest.mark.parametrize("name", ["op3_toxicity"])
def test_query_gives_every_document(query, spark, sf_dir, name):
    got = query(name, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    changed = labels.withColumn("toxic", labels.toxic.cast("int"))
    assert toxic_lexicon(docs, labels) == toxic_lexicon(docs, changed)


def plain_score(text, lexicon):
    """Word by word, with every entry and every exception tried on every word."""
    folded = fold(text)
    words = folded[1:-1].split(" ")  # empty where several spaces stand in a row
    counts = {}
    for k, word in enumerate(words):
        if not word:
            continue
        around = [f" {words[k - 1]} {word} "] if k and words[k - 1] else []
        around += [f" {word} {words[k + 1]} "] if k + 1 < len(words) and words[k + 1] else []
        if set(around) & set(lexicon.exceptions):
            continue
        fits = [e for e in lexicon.weights if f" {word} ".startswith(e)]
        if fits:
            best = max(fits, key=lambda e: lexicon.weights[e])
            counts[best] = counts.get(best, 0) + 1
    weight = sum(lexicon.weights[e] * (1 + math.log(n)) for e, n in counts.items())
    a, b, c = lexicon.curve
    logit = a + b * math.log1p(weight) + c * math.log1p(1000 * weight / len(folded))
    return 1 / (1 + math.exp(-logit)), sorted(e.strip() for e in counts)


def test_scores_against_plain_loops(spark):
    rng = random.Random(8)
    letters = ["a", "b", "1", "@", "é", "ж", "中", " ", " ", "  ", "-", "."]
    lexicon = Lexicon(
        {" ab": 2.0, " aba ": 3.5, " b ": 0.7, " é": 1.1, " " + "ab" * 150 + " ": 5.0, " 中": 0.3},
        (" ab ba ", " b b ", " " + "ab" * 150 + " a "),
        (-2.0, 1.5, 0.5),
    )
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(300)]
    texts += ["x " + "ab" * 150 + " y", "ab" * 150 + " a", "ab ab ba b b b", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = with_toxicity(df, lexicon).orderBy("doc_id").collect()
    for row, text in zip(got, texts):
        score, matches = plain_score(text, lexicon)
        assert row.toxicity.score == pytest.approx(score, abs=1e-12)
        assert row.toxicity.matches == matches


def test_the_bar_follows_the_labels(spark):
    """Few labels with one clear word give an entry; many labels without any give none."""
    rng = random.Random(9)
    few = [(k, " ".join(rng.choices(WORDS, k=12)) + (" zid" if k % 5 == 0 else ""), int(k % 5 == 0)) for k in range(60)]
    docs = spark.createDataFrame(few, "doc_id long, text string, toxic int")
    lexicon = learn_lexicon(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert [e.strip() for e in lexicon.weights] == ["zid"]
    none = [(k, " ".join(rng.choices(WORDS, k=12)), int(rng.random() < 0.2)) for k in range(1500)]
    docs = spark.createDataFrame(none, "doc_id long, text string, toxic int")
    lexicon = learn_lexicon(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert len(lexicon.weights) <= 1


def test_words_of_any_length_can_be_entries(spark):
    word = "q" + "xyz" * 30
    rows = [(k, f"{word if k % 2 else 'it'} {rng_word(k)}", k % 2) for k in range(80)]
    rows += [(100 + k, f"{'pq' if k % 2 else 'rs'} {rng_word(100 + k)}", k % 2) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = learn_lexicon(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert " pq " in lexicon.weights
    assert f" {word} " in lexicon.weights


def rng_word(k):
    return "".join(random.Random(k).choices("abcdefgh", k=6))
