import random

from kestrel.llm.decontam import EDITS, contaminated, op3_block_max_wand
from kestrel.llm.words import words_of

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def items():
    rng = random.Random(5)
    prose = lambda n: " ".join(f"v{rng.randrange(400)}" for _ in range(n))
    out = []
    for answer in (1, 2, 3, 5, 9, 15):
        out += [f"{prose(22)}? {prose(answer)}.", f"Question: {prose(25)} Answer: {prose(answer)}", f"{prose(24)}. {prose(answer)}."]
    return out + [prose(26), prose(30) + "?"]


def test_an_item_with_any_one_word_replaced_is_found(spark):
    rng = random.Random(6)
    texts, docs = items(), []
    for i, text in enumerate(texts):
        words = [w.decode() for w in words_of(text)]
        for k in range(len(words)):
            edited = words[:k] + ["other"] + words[k + 1:]
            docs.append((1000 * i + k, " ".join(f"p{rng.randrange(90)}" for _ in range(30)) + " " + " ".join(edited)))
    got = contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(list(enumerate(texts)), ITEMS), edits=EDITS).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, d // 1000) for d, _ in docs}


def test_a_long_answer_and_the_words_in_order_are_still_asked_for(spark):
    rng = random.Random(7)
    text = items()[12]  # a question with an answer of nine words
    question = text.split("?")[0]
    shuffled = text.replace("?", "").replace(".", "").split()
    rng.shuffle(shuffled)
    docs = [(1, question + " and nothing of its answer"), (2, " ".join(shuffled)), (3, text)]
    got = contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(0, text)], ITEMS), edits=EDITS).collect()
    assert [r.doc_id for r in got] == [3]


def test_query_allows_an_edited_word(spark, tmp_path):
    text = "which of these words stands at the very end of this long benchmark question? certainly omega."
    spark.createDataFrame([(1, "so: " + text.replace("omega", "alpha"))], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, text)], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.item_id for r in op3_block_max_wand(spark, str(tmp_path)).collect()] == [0]
