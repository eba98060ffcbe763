"""The draw and the table agree on texts without words."""

from icufeat.llm import mixing
from tests.llm.cases import words


def test_texts_without_words_are_not_drawn(spark):
    rows = [(i, words(i, 8) if i % 3 else (None, "", "  ")[i // 3 % 3], "en", f"s{i % 2}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    selected = {r.doc_id for r in mixing.mix_table(docs, budget=0.9).filter("selected").collect()}
    drawn = {r.doc_id for r in mixing.draw(docs, budget=0.9).collect()}
    assert drawn == selected and drawn and all(i % 3 for i in drawn)
