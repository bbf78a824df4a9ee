"""Leaks: copies, other numbers and names, slots that disagree, the shuffled join."""

import pytest
from pyspark.sql import functions as F

from pubgrade.llm import decontaminate

QUESTION = "At the market Anna buys 12 apples for 3 dollars each and then sells 12 pears to Paul for 5 kg of rice."
FILL = "Some other words stand here before anything else comes along in this text. "


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, QUESTION), (2, "Entirely different words that are found in no document of this small test at all."), (3, None), (4, "too short")]
    return spark.createDataFrame(rows, "item_id long, text string")


DOCS = [
    (10, FILL + QUESTION),
    (11, FILL + QUESTION.replace("12", "40").replace("Anna", "Maria").replace("3", "7").replace("kg", "lbs") + " " + FILL),
    (12, QUESTION.replace("buys 12", "buys 13")),  # twelve would stand for two values
    (13, FILL),
    (14, None),
    (15, ""),
    (16, QUESTION[:30]),
    (None, QUESTION),
]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WINDOWS, 0])
def test_leaks(docs, items, limit):
    found = decontaminate.find_leaks(docs(*DOCS, DOCS[0]), items, broadcast_windows=limit).collect()
    assert {(r.doc_id, r.item_id, r.exact) for r in found} == {(10, 1, True), (11, 1, False), (None, 1, True)}
    assert len(found) == 3


def test_rows_without_leaks_stay(docs, items):
    df = docs(*DOCS, DOCS[3], (10, FILL))
    kept = decontaminate.drop_leaks(df, items)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [10, 12, 13, 13, 14, 15, 16]
    assert decontaminate.find_leaks(df.where("false"), items).count() == 0
    assert decontaminate.drop_leaks(df, items.where("false")).count() == df.count()


def test_template_keeps_words_apart(spark):
    text = "He paid $3.50 for 12 km, then John Smith Jr. went."
    row = spark.createDataFrame([(text,)], "text string").select(decontaminate.template(F.col("text"))).first()
    assert row[0] == "he paid <unit><num> for <num> <unit> then <name> <name> <name> went"
    assert len(row[0].split()) == len(text.split())


VARIED = [
    # question, the same in another wording
    ("In the summer Anna Smith met Paul in Rome and then saw Maria in Berlin before going home.", str.upper),
    ("In the summer Anna Smith met Paul in Rome and then saw Maria in Berlin before going home.", str.lower),
    (
        "A farmer has three baskets with some apples and gives five of them to the children who live near the old mill.",
        lambda q: q.replace("three", "seven").replace("five", "twenty nine"),
    ),
    ("Tom goes to the old shop. Tom buys some bread there. Tom pays and goes back to the house.", lambda q: q.replace("Tom", "Anna")),
    ("The big tank of the house holds 40 litres of water and the pump needs an hour to fill it.", lambda q: q.replace("40", "1 250")),
    ("The small bag on the table weighs 7 kg and the large one next to it weighs far more than that.", lambda q: q.replace("7 kg", "9 KG")),
]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WINDOWS, 0])
def test_other_case_number_words_first_names_and_digit_groups(spark, docs, limit):
    items = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(VARIED)], "item_id long, text string")
    df = docs(*[(i, FILL + change(q) + " " + FILL) for i, (q, change) in enumerate(VARIED)], (90, FILL))
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, items, broadcast_windows=limit).collect()}
    assert found == {(i, i) for i in range(len(VARIED))} | {(0, 1), (1, 0)}
    assert [r.doc_id for r in decontaminate.drop_leaks(df, items).collect()] == [90]


def test_wider_slots_must_agree(spark, docs):
    items = spark.createDataFrame([(1, VARIED[3][0])], "item_id long, text string")
    text = VARIED[3][0].replace("Tom buys", "Anna buys")  # Tom would stand for two names
    assert decontaminate.find_leaks(docs((1, text)), items).count() == 0


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WINDOWS, 0])
def test_items_without_template_windows(spark, docs, limit):
    questions = [
        "What is the capital of France?",
        "Compute the sum 12 15 18 21 24 27 30 33 36",
        "<ul> <li> a </li> <li> b </li> <li> c </li> </ul>",
        "Why?",
    ]
    items = spark.createDataFrame([*enumerate(questions), (9, ""), (10, None)], "item_id long, text string")
    rows = [(i, FILL + q + " " + FILL) for i, q in enumerate(questions)]
    rows[3] = (3, FILL + "\n Why? \n" + FILL)
    df = docs(*rows, (30, FILL + "Why? " + FILL), (20, FILL + "WHAT IS the capital of france"), (21, FILL + "What is the capital of Spain?"), (22, "15 18 21"), (23, None), (24, FILL))
    found = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.find_leaks(df, items, broadcast_windows=limit).collect()}
    assert found == {(i, i, True) for i in range(4)} | {(20, 0, True)}
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(df, items).collect()) == [21, 22, 23, 24, 30]


def test_plans_hold_no_filter(docs, items, monkeypatch):
    """The filter of anchors is looked up, as a constant it filled plans and the driver's memory."""
    store, sizes = decontaminate.cut_lineage, []

    def measured(df, name):
        sizes.append(len(df._jdf.queryExecution().toString()))
        return store(df, name)

    monkeypatch.setattr(decontaminate, "cut_lineage", measured)
    found = decontaminate.find_leaks(docs(*DOCS), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 1), (11, 1), (None, 1)}
    assert max(sizes) < 200_000
