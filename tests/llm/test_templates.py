"""Re-worded questions that decontamination must find, and others that it must leave alone."""

import pytest

from fareloom.llm import decontaminate

SEVEN = "Tom has five red balls and Mary has seven. How many balls do they have together?"
APPLES = "Anna has 12 apples. Anna gives 3 apples to her friend Ben. How many apples does Anna have left after that?"
TRAIN = "A train leaves Boston at 9:30 and travels 120 miles in two hours. What is the average speed of the train?"
BASKET = 'Mrs. Baker said "I need 24 eggs." Then Sam bought twenty-five eggs for 6 dollars. How many eggs were left over?'

ALIKE = [
    (SEVEN, "Bob has nine red balls and Jane has six. How many balls do they have together?"),
    (SEVEN, "Mary Ann has 5 red balls and Uncle Joe has twelve. How many balls do they have together?"),
    (SEVEN, "TOM has five red balls and MARY has seven. How many balls do they have together?"),
    (APPLES, APPLES.replace("Anna", "Mary Ann Smith")),
    (APPLES, APPLES.replace("Anna", "Peter").replace("12", "40").replace("3", "eleven")),
    (TRAIN, TRAIN.replace("Boston", "New York").replace("9:30", "10:15").replace("two", "3")),
    (BASKET, BASKET.replace("Sam", "Little Tim").replace("twenty-five", "18").replace("6", "nine")),
]
UNLIKE = [
    (SEVEN, "Tom has five red balls and that is all that anybody knows about Tom and his red balls today."),
    (APPLES, "Anna has 12 apples. She likes them very much and would not give one of them to anybody at all, ever."),
    (TRAIN, "A bus leaves the city at 9:30 and stops for 20 minutes at every corner. When does it reach the lake?"),
]


def held(spark, item, text):
    docs = spark.createDataFrame([(1, f"Some words stand before it. {text} And some more come after it."), (2, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    return {r.doc_id: r for r in decontaminate.contaminated(docs, items).collect()}


@pytest.mark.parametrize("item,text", ALIKE)
def test_reworded_questions_are_found(spark, item, text):
    rows = held(spark, item, text)
    assert set(rows) == {1, 2}
    assert rows[2].coverage >= 0.75
    assert (rows[2].n_changed > 0) == (text.lower() != item.lower())


@pytest.mark.parametrize("item,text", UNLIKE)
def test_other_questions_are_not(spark, item, text):
    assert not held(spark, item, text)


def test_a_name_must_stand_for_the_same_name_throughout(spark):
    mixed = APPLES.replace("Anna has 12", "Peter has 12").replace("Anna gives", "Maria gives")
    rows = held(spark, APPLES, mixed)
    assert all(r.coverage < 0.75 for r in rows.values())
    assert held(spark, APPLES, APPLES)[1].n_changed == 0
