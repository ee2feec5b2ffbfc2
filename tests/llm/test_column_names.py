"""Columns of any name pass through the operators that keep them, and clashing ones are replaced."""

from telemill.llm import decontamination, exact_dedup, language

NAMES = "doc_id long, text string, `a.b` int, `c``d` int, lang_pred string, hits int"


def table(spark):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    return spark.createDataFrame([(1, words, 1, 2, "x", 3), (2, "some other text", 1, 2, "x", 3), (3, "some other text", 1, 2, "x", 3)], NAMES), words


def test_names_with_dots_and_backticks(spark):
    df, words = table(spark)
    benchmark = spark.createDataFrame([("item-a", words)], "item_id string, text string")  # ids that are text
    kept = decontamination.filter(df, benchmark)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    found = decontamination.matched(df, benchmark)
    assert found.columns == [c for c in df.columns if c != "hits"] + ["hits"]
    assert [h.item for r in found.filter("doc_id = 1").collect() for h in r.hits] == ["item-a"]
    assert sorted(r.doc_id for r in exact_dedup.filter(df).collect()) == [1, 2]
    assert exact_dedup.filter(df).columns == df.columns


def test_a_column_of_the_prediction_is_replaced(spark):
    df, _ = table(spark)
    out = language.identify(df, {"en": ["some other text and words"], "de": ["ein ganz anderer satz"]})
    assert out.columns == ["doc_id", "text", "a.b", "c`d", "hits", "lang_pred", "score"]
    assert {r.lang_pred for r in out.collect()} <= {"en", "de"}
    one = language.identify(df, {"en": ["some other text"]}).collect()  # a single learned language
    assert {r.lang_pred for r in one} == {"en"} and all(0 <= r.score <= 1 for r in one)
    none = language.identify(df, {}).collect()
    assert {r.lang_pred for r in none} == {language.UNKNOWN}
