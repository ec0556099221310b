import pytest
import regex

from granary.llm import decontamination, queries
from tests.llm.cases import DOCS, awkward, rows_of, with_clashes

ITEM = "At the market Anna buys 12 apples for 3 dollars each and then Anna sells 5 apples to Peter before she walks 2.5 km home."
FILLER = "Nothing here is like any question that was ever asked by any one. "


def found(spark, text, **more):
    docs = spark.createDataFrame([(1, text, "en", "s", 0)], DOCS)
    items = spark.createDataFrame([(10, ITEM), (11, None), (None, ITEM), (12, "too short")], "item_id long, text string")
    return decontamination.find_leaks(docs, items, **more).collect()


@pytest.mark.parametrize("text,exact", [
    (ITEM, True),
    (FILLER + ITEM + " " + FILLER, True),
    (FILLER + ITEM.replace("Anna", "Mary Jane").replace("12", "1,400").replace("2.5 km", "7 miles").replace("Peter", "Paul"), False),
])
def test_the_same_question_in_other_words(spark, text, exact):
    ((doc, item, coverage, slots, same),) = found(spark, text)
    assert (doc, item, same) == (1, 10, exact) and coverage > 0.9 and slots >= 6


@pytest.mark.parametrize("text", [
    FILLER * 5,
    ITEM.replace("then Anna", "then Mary"),  # one name of the item would stand for two
    " ".join(ITEM.split()[:11]),  # less than half of it
    "12 3 5 2.5 km 7 8 9 10 11 12 13 14",
])
def test_other_texts(spark, text):
    assert found(spark, FILLER + text) == []


def test_any_number_of_bits(spark, sf_dir):
    """Bits only spare work: so few that every window is marked give the same pairs."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    one = decontamination.find_leaks(docs, items)
    assert rows_of(one) == rows_of(decontamination.find_leaks(docs, items, most_bits=64))


def test_whole_table_holds_every_copied_item(spark, larger):
    got = {(r.doc_id, r.item_id) for r in queries.op4_template_decontamination(spark, larger).collect()}
    items = spark.read.parquet(f"{larger}/benchmark.parquet").collect()
    copied = {(d.doc_id, b.item_id) for d in spark.read.parquet(f"{larger}/documents.parquet").collect() for b in items if b.text in d.text}
    assert copied and got == copied


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op4_template_decontamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    items = spark.createDataFrame([(1, None), (2, ""), (3, ITEM), (3, ITEM), (3, FILLER)], "item_id long, text string")
    assert decontamination.find_leaks(docs, items).collect() == []
    assert decontamination.find_leaks(docs.limit(0), items).collect() == []
    assert decontamination.find_leaks(docs, items.limit(0)).collect() == []
    twice = docs.select("doc_id").where("doc_id = 7").selectExpr("doc_id", f"'{ITEM}' as text")
    assert [(r.id, r.item) for r in decontamination.find_leaks(twice, items).collect()] == [(7, 3)]


@pytest.mark.parametrize("text", [
    ITEM.replace("and then", "and only then"),  # a word more
    ITEM.replace("each and then", "each then"),  # a word less
    ITEM.replace("and then", "but then"),  # another word
    ITEM.replace("each and", "all and").replace("before she", "until she"),  # two other words, eight tokens apart
    " ".join(ITEM.split()[:16]) + " 77 others go and Lisa stays.",  # cut short: the rest has nothing to do with the item
])
def test_edited_and_truncated_copies(spark, text):
    assert [(r.id, r.item) for r in found(spark, FILLER + text + " " + FILLER)] == [(1, 10)]


def test_a_long_run_of_a_longer_item(spark):
    item = ITEM + " " + " ".join(f"{w} follows here and there" for w in "alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    docs = spark.createDataFrame([(1, FILLER + " ".join(ITEM.split()[:18]), "en", "s", 0)], DOCS)
    got = decontamination.find_leaks(docs, spark.createDataFrame([(10, item)], "item_id long, text string")).collect()
    assert [(r.id, r.item) for r in got] == [(1, 10)] and got[0].coverage < 0.5


STORY = "Anna buys 12 apples. Anna eats 5 of the apples today. Anna sells 3 apples for 2 dollars."


def matches(spark, item, texts):
    """What is found of one item in each text, also with other text around it: None, or whether all slots are the item's."""
    rows = [*enumerate(texts), *((1000 + k, FILLER + "\n" + t + "\n" + FILLER) for k, t in enumerate(texts))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: r.exact for r in decontamination.find_leaks(docs, spark.createDataFrame([(10, item)], "item_id long, text string")).collect()}
    assert [k in found for k in range(len(texts))] == [1000 + k in found for k in range(len(texts))]
    return [found.get(k) for k in range(len(texts))]


def test_openers_case_and_line_breaks(spark):
    assert matches(spark, STORY, [
        STORY.replace("Anna", "Mary"), STORY.replace("Anna", "Mary Jane").replace("12", "40"),  # names that begin sentences
        STORY.lower().replace("12", "13"), STORY.lower(), STORY.upper(), '"' + STORY + '"', "- " + STORY.replace(". ", ".\n- "),
    ]) == [False, False, False, True, True, True, True]
    assert matches(spark, STORY, ["Heading Of The Page\n" + STORY, ITEM, STORY.replace("apples", "pears").replace("buys", "finds").replace("eats", "throws").replace("sells", "keeps")]) == [False, None, None]


def test_names_within_sentences(spark):
    assert matches(spark, ITEM, [
        ITEM.lower(), ITEM.upper(), ITEM.replace(" ", "\n"), ITEM.replace(" ", " \r\n ", 9),
        ITEM.replace("Peter", "Anna"),  # two names of the item became one
        ITEM.replace("then Anna", "then Mary"),  # one became two
        ITEM.replace("Peter", "New\n  York").replace("Anna", "Mary"), STORY,
    ]) == [True, True, True, True, None, None, False, None]


def brute(docs, items, width=8, run=13):
    """Pairs by a plain matcher: share of the item's windows of words in the document, numbers left out of the words."""
    tokens = lambda t: ["#" if w[0].isdigit() else w.lower() for w in regex.findall(r"[0-9]+(?:[.,:/][0-9]+)*|\p{L}+", t)]
    windows = lambda t: {tuple(t[k:k + width]) for k in range(len(t) - width + 1)}
    wanted = {i: windows(tokens(t)) for i, t in items}
    out = set()
    for d, text in docs:
        own = windows(tokens(text))
        out |= {(d, i) for i, w in wanted.items() if w and len(w & own) >= 0.5 * len(w)}
    return out


def test_edited_items_in_a_whole_table(spark, larger):
    """Every item of the table, edited in several ways, put into documents of the table: all found, and nothing else."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{larger}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{larger}/documents.parquet").collect()]
    before = brute(docs, items)
    leaking = {d for d, _ in before}
    clean = [t for d, t in docs if d not in leaking]
    edits = [lambda t: t, str.lower, lambda t: "\r\n".join(t.split()), lambda t: t.upper(),
             lambda t: " ".join(w if k != 13 or len(t.split()) < 28 else "changed" for k, w in enumerate(t.split()))]
    planted, expected = [], set()
    for k, (item, text) in enumerate(items):
        for j, edit in enumerate(edits):
            planted.append((100_000 + 10 * k + j, clean[(7 * k + j) % len(clean)] + "\n" + edit(text) + "\n" + clean[(3 * k) % len(clean)]))
            expected.add((planted[-1][0], item))
    frame = spark.createDataFrame(planted + docs, "doc_id long, text string")
    got = {(r.id, r.item) for r in decontamination.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == expected | before


@pytest.mark.parametrize("unit", ["Ab ", "McDonald\n", "1,2,3/"])
def test_long_runs_of_names_or_numbers(spark, unit):
    """A run of any length is one token; matching it must not go a call deeper for each of its parts."""
    ((doc, item, _, _, same),) = found(spark, FILLER + unit * 100_000 + ". " + ITEM)
    assert (doc, item, same) == (1, 10, True)
