from visitmart.llm.decontamination import contaminated, drop_contaminated


def test_items_of_few_words_are_found_inside_longer_texts(spark):
    docs = spark.createDataFrame([(1, "it says The answer, is here"), (2, "the answer was"), (3, "the answer is"), (4, "is")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "the answer is"), (8, "one two three four five six")], "item_id long, text string")
    for block in (1, 10):
        got = sorted((r["doc_id"], r["item_id"], r["similarity"], r["first_word"]) for r in contaminated(docs, items, block=block).collect())
        assert got == [(1, 7, 1.0, 2), (3, 7, 1.0, 0)]
        assert sorted(r["doc_id"] for r in drop_contaminated(docs, items, block=block).collect()) == [2, 4]
