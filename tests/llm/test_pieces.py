"""Units of few words, and passages pasted into the middle of sentences."""

import random

from leafmill.llm import unit_dedup


def test_short_units_repeat(spark):
    docs = [(1, "One text here.\nAll rights reserved.\n"), (2, "Another text.\nAll rights reserved.\n"), (3, "...\n"), (4, "...\n")]
    got = {r["doc_id"]: r["text"] for r in unit_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"), "line", 1).collect()}
    assert got == {1: docs[0][1], 2: "Another text.\n", 3: "...\n", 4: "...\n"}


def test_pasted_passages_resynchronise(spark):
    rng = random.Random(7)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = " ".join(words(60))
    docs = [(i, " ".join(words(20)) + f" {passage} " + " ".join(words(20))) for i in range(12)]
    got = {r["doc_id"]: r for r in unit_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[0]["n_removed_chars"] == 0
    assert all(0.5 * len(passage) <= got[i]["n_removed_chars"] <= len(passage) + 2 for i in range(1, 12))
    for _, text in docs:
        assert "".join(unit_dedup.pieces_of(text)) == text
