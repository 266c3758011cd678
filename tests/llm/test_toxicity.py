import numpy as np
import pytest
from farelake.llm import queries, toxicity
from farelake.llm.toxicity import Lexicon, Matcher, fold, score_texts

RUDE = Lexicon(((" idiot ", 0), (" clown ", 0), (" scum ", 0), (" bad", 3)), (3.0, 3.0, 2.0, 4.0), -4.0)


def reached(text):
    return Matcher(RUDE.entries, RUDE.exceptions).hits(fold(text)).tolist()


def test_folding():
    assert fold("You ID1OT, 1d10t!") == " you idiot idiot "
    assert fold("іdiоt ｉｄｉｏｔ") == " idiot idiot "
    assert fold("in 2024 we paid 5 $") == " in we paid "
    assert fold("réeux ÉÀ") == " réeux éà "
    assert fold(None) == fold("") == "  " or fold(None).strip() == ""


def test_matching():
    assert reached("an 1d1ot here")[0] and not reached("idiotic ideas")[0]
    assert reached("the clown") == [False, True, False, False]
    assert not any(reached("a clown fish swims by the trash can"))
    assert reached("a clown fish and a clown")[1]
    assert reached("badly " * 5)[3]
    assert not reached("badly " + "word " * 500 + "badly")[3]  # too rare for the length


def test_scores_of_edge_rows(edge, edge_rows):
    rows = score_texts(edge, RUDE).collect()
    assert len(rows) == len(edge_rows)
    assert all(0 < r.score < 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_empty_tables(spark, empty):
    lexicon = toxicity.learn(empty, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert lexicon.entries == ()
    assert score_texts(empty, lexicon).count() == 0
    docs = spark.createDataFrame([(1, "anything"), (2, None)], "doc_id long, text string")
    assert {r.score for r in score_texts(docs, lexicon).collect()} == {0.5}


def test_learning_leaves_out_missing_labels(spark):
    rows = [(i, f"word{i} plain text {'nasty' if i % 5 == 0 else 'nice'} end") for i in range(400)]
    rows += [(1000 + i, "nasty") for i in range(50)]
    labels = [(i, int(i % 5 == 0) if i < 400 else None) for i, _ in rows] + [(99_999, 1)]
    lexicon = toxicity.learn(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    )
    assert " nasty " in {pattern for pattern, _ in lexicon.entries}
    docs = spark.createDataFrame([(1, "a NASTY one"), (2, "a n4sty one"), (3, "a nice one")], "doc_id long, text string")
    assert [r.predicted for r in score_texts(docs, lexicon).orderBy("doc_id").collect()] == [1, 1, 0]


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.1"
    return queries.toxicity_scores(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()


def test_held_out_accuracy(scored):
    held = scored[scored.held_out]
    assert set(held.doc_id) == {i for i in scored.doc_id if __import__("zlib").crc32(str(i).encode()) % 3 == 1}
    a, b = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert np.mean(a[:, None] > b[None, :]) + 0.5 * np.mean(a[:, None] == b[None, :]) > 0.93
    assert held[held.predicted == 1].toxic.mean() > 0.97
    assert held[held.toxic == 1].predicted.mean() > 0.8


def test_substitutes_at_the_ends_and_behind_signs():
    forms = {
        "garbag3": "garbage",
        "g4rb4g3": "garbage",
        "usele55": "useless",
        "worthle55": "worthless",
        "(1diot)": "idiot",
        '"st00pid': "stoopid",
        "-idi0t": "idiot",
        "_idi0t_": "idiot",
        "(idi0t!!)": "idiot",
        "usele55!": "useless",
        "covid19": "covid",
    }
    assert {form: fold(form).strip() for form in forms} == forms


def test_signs_that_may_be_no_letters():
    matcher = Matcher(RUDE.entries, RUDE.exceptions)
    for text in ("idiot5", "(@idiot", "idiot$$$", "@1diot5", "#1idiot", "an idi0t!1!1"):
        assert matcher.hits(*toxicity.readings(text))[0], text
    assert not any(matcher.hits(*toxicity.readings("a clown5 fish3, the trash can1")))
    # A word is counted once, however many readings have the pattern.
    assert not matcher.hits(*toxicity.readings("badly5 " + "word " * 5))[3]
    assert len({len(t.split()) for t in toxicity.readings("a2$ 9b5 $c$ 2x5x2 19 u5 @b2b@ x!y! ٣z5")}) == 1
    found = toxicity.candidates(*toxicity.readings("stupid5 day"))
    assert {(" stupid ", 0), (" stupids ", 0), (" day ", 0)} <= found
