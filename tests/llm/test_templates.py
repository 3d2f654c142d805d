"""Templates against a plain Python reading of the same rules: words, windows, slots."""

import re

import pytest
import regex

from tallyspark.llm import catalog, templates

SF = "/root/testdata/sf0.001"
SEVERAL = {
    "MANY": templates.NUMBERS, "SCALE": templates.SCALES, "TEN": templates.TENS, "ONE": templates.ONES,
}


def words(text):
    """(mark, word) of a text: "n" a name, "e" a word that may be one, "#" a number in several words, "" any other."""
    pieces = [(m.group(), m.start(), m.end()) for m in regex.finditer(r"[\p{L}\p{N}]+(?:(?<=[0-9])[.,:/](?=[0-9])[\p{L}\p{N}]+)*", text)]
    out = []
    for n, (word, start, end) in enumerate(pieces):
        before = text[pieces[n - 1][2] : start] if n else None
        low = re.sub(r"(?<=[0-9])[.,:/](?=[0-9])", "", word).lower()
        capital = regex.match(r"\p{Lu}\p{Ll}", word) is not None
        after = text[:start]
        name = capital and regex.search(r"[\p{L}\p{N},;:)\"']\s{1,3}$", after) is not None
        mark = "n" if name else "e" if capital else ""
        if len(out) > 1 and out[-1][1] == "and" and out[-2][2] in SEVERAL["SCALE"] and low in SEVERAL["MANY"] and before.isspace() and len(before) <= 3:
            out.pop()
            out[-1] = ("#" + out[-1][0].strip("#"), out[-1][1] + " and " + low, low)
            continue
        if out:
            last_mark, last, tail = out[-1]
            joins = re.fullmatch(r"[\s-]{1,3}", before)
            if joins and (
                (low in SEVERAL["SCALE"] and tail in SEVERAL["MANY"]) or (low in SEVERAL["ONE"] and tail in SEVERAL["TEN"])
                or (low in SEVERAL["MANY"] and tail in SEVERAL["SCALE"])
            ):
                out[-1] = ("#" + last_mark.strip("#"), last + " " + low, low)
                continue
            if name and re.fullmatch(r"\s{1,3}", before) and (last_mark == "n" or last_mark == "e" and tail not in templates.OPENERS):
                out[-1] = (last_mark, last + " " + low, low)
                continue
        out.append((mark, low, low))
    return [(mark, word) for mark, word, _ in out]


def template(tokens, named):
    kinds = []
    for mark, word in tokens:
        if "n" in mark:
            kinds.append("<name>")
        elif word[0] in "0123456789" or word in templates.NUMBERS or "#" in mark:
            kinds.append("<number>")
        elif word in templates.UNITS:
            kinds.append("<unit>")
        else:
            kinds.append("<name>" if named and "e" in mark else word)
    return kinds


def places_of(theirs, size):
    """Places of each window of a document, in both readings."""
    found = {}
    for reading in (template(theirs, False), template(theirs, True)):
        for at in range(len(reading) - size + 1):
            found.setdefault(tuple(reading[at : at + size]), set()).add(at)
    return found


def holds(document, item, memory=None):
    """Whether a document (its words) holds an item (its words) whose windows all have enough literal words; None if some have not."""
    size, best, memory = min(len(item), templates.WINDOW), 0.0, {} if memory is None else memory
    readings = [named for named in (False, True) if not named or template(item, True) != template(item, False)]
    if len(item) < templates.MIN_WORDS:
        return None
    starts = range(len(item) - size + 1)
    for named in readings:
        want, found, shifts = template(item, named), set(), {}
        if any(sum(w[0] == "<" for w in want[s : s + size]) > size * (1 - templates.MIN_LITERALS) for s in starts):
            return None
        if size not in memory:
            memory[size] = places_of(document, size)
        for place in starts:
            for at in memory[size].get(tuple(want[place : place + size]), ()):
                shifts.setdefault(at - place, []).append(place)
        for shift, places in shifts.items():
            there, back = {}, {}
            for at in {p + i for p in places for i in range(size) if want[p + i][0] == "<"}:
                there.setdefault((want[at], item[at][1]), set()).add(document[at + shift][1])
                if want[at] != "<number>":
                    back.setdefault((want[at], document[at + shift][1]), set()).add(item[at][1])
            if all(len(v) == 1 for v in [*there.values(), *back.values()]):
                found.update(places)
        best = max(best, len(found) / len(starts))
    return best >= templates.COVERAGE


ITEMS = {
    1: "Tom buys 12 pears for 3 dollars each.",
    2: "John has 12 apples and Mary gives him 7 more apples. How many apples does John have now in total?",
    3: "A farmer sells forty eggs to Mary Ann Lee and keeps two hundred and five eggs at home for the winter.",
}
COPIES = [
    (1, "So: Anna buys one pears for twenty-five cents each. Yes."),
    (1, "Anna buys 5 pears for 5 dollars each."),
    (1, "Mary Ann buys 5 pears for three hundred dollars each."),
    (1, "Anna buys twenty\nfive pears for 6 euros each."),
    (2, "Ann has 4 apples and Bob gives him 4 more apples. How many apples does Ann have now in total?"),
    (2, "Mary Ann has one apples and Bob Lee gives him two more apples. How many apples does Mary Ann have now in total?"),
    (3, "A farmer sells 7 eggs to Tom and keeps eight eggs at home for the winter."),
    (None, "Peter has 15 apples and Anna gives him 3 more apples. How many apples does Anna have now in total?"),
    (None, "Nobody buys anything in twenty-five shops, and three hundred and one people say so."),
    (None, ""),
]


@pytest.fixture
def frames(spark):
    items = spark.createDataFrame(list(ITEMS.items()), "item_id long, text string")
    docs = spark.createDataFrame([(n, "x", text) for n, (_, text) in enumerate(COPIES)], "doc_id long, item_id string, text string")
    return docs, items


def test_numbers_and_names_of_several_words_fill_one_slot(frames):
    found = {(r.doc_id, r.item_id) for r in templates.contaminated(*frames).collect()}
    assert found == {(n, item) for n, (item, _) in enumerate(COPIES) if item}


def test_plain_rules_agree_on_copies(frames):
    found = {(r.doc_id, r.item_id) for r in templates.contaminated(*frames).collect()}
    assert found == {(n, i) for n, (_, text) in enumerate(COPIES) for i, item in ITEMS.items() if holds(words(text), words(item))}


def test_item_behind_a_name_or_number_is_found_word_for_word(spark):
    items = spark.createDataFrame([(1, "Ada Lovelace, Alan Turing"), (2, "five 6 7")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "said by John Ada Lovelace, Alan Turing"), (2, "two hundred five 6 7"), (3, "Ada Turing, Alan")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in templates.contaminated(docs, items).collect()} == {(1, 1), (2, 2)}


def test_plain_rules_agree_on_the_given_tables(spark):
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {(r.doc_id, r.item_id) for r in catalog.QUERIES["op2_templates"](spark, SF).collect()}
    checked = 0
    for row in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        document, memory = words(row.text or ""), {}
        for item_id, item in items:
            want = holds(document, item, memory)
            if want is not None:
                checked += 1
                assert ((row.doc_id, item_id) in found) == want, (row.doc_id, item_id)
    assert checked > 1000


def test_windows_are_hashed_by_compiled_code(frames):
    docs, items = frames
    plan = templates.matched_windows(docs, templates.benchmark_windows(items))._jdf.queryExecution().executedPlan().toString()
    documents = plan[: plan.index("BroadcastExchange")]
    assert "slice(" not in documents and documents.count("Generate explode") == 2


def test_numbers_of_several_words_in_any_case(spark):
    texts = ["TWENTY-Five pears", "Two HUNDRED and\nSix pears", "a Million five", "seventy  one, Forty", "twentyfive hundredths", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: r.tokens for r in rows.select("doc_id", templates.tokens_of(rows["text"]).alias("tokens")).collect()}
    for n, text in enumerate(texts):
        plain = [re.sub(r"[\x04\x05]", " ", re.sub(r"[\x01\x02]", "", token)) for token in found[n]]
        assert plain == [word.replace(" and ", " ") for _, word in words(text or "")], text
