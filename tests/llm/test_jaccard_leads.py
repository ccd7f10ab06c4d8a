from playstats.llm.jaccard_join import drop_near_copies


def test_one_of_the_texts_of_an_id_leads(table):
    text = "one two three four five six seven"
    pairs = [(5, text), (5, text.upper()), (5, text.replace(" ", "  ")), (6, text), (None, "eight " + "nine " * 9), (None, "Eight " + "nine " * 9)]
    assert sorted((r["doc_id"] for r in drop_near_copies(table(pairs)).collect()), key=str) == [5, None]
