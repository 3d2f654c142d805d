"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders; windows of the resulting
templates are hashed, and those of documents joined with those of benchmark items. A
window says which value stands in which slot: an occurrence of an item counts only if
every slot value of the item goes to one value of the document, and names and units back, too (two
numbers may get the same value). So a question with other numbers or names is found, and a mere
resemblance of placeholders is not.

A capitalised word that begins a sentence may be a name or not, so templates are hashed in
both readings: such words as they are, and all of them as names. The slot check is done
for each reading of an item by itself.

Windows with few literal words say too little as templates. Items that have any, and items of
few words, are also looked for word for word: the hashes of their words as they are.
All of it is DataFrame functions.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.texts import unused
from tallyspark.session import stored

WINDOW = 8
# Items of fewer words are found word for word only; a shorter item than a window is one window.
MIN_WORDS = 5
# Literal words that a window needs: half of it.
MIN_LITERALS = 0.5
# Share of an item's windows found in a document that makes it contaminated.
COVERAGE = 0.5
# Window or document rows that may be broadcast: some tens of MB. Larger tables are shuffled.
BROADCAST_ROWS = 500_000

# Words for numbers and units.
NUMBERS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half once twice thrice"
).split()
ONES = "one two three four five six seven eight nine".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = "hundred thousand million billion".split()
UNITS = (
    "mm cm km kg mg ml kb mb gb mph kph hz khz mhz ghz meter meters metre metres centimeter centimeters kilometer kilometers "
    "kilometre kilometres mile miles inch inches foot feet yard yards gram grams kilogram kilograms pound pounds ounce ounces "
    "ton tons liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years dollar dollars cent cents euro euros percent degrees celsius fahrenheit volts watts joules"
).split()
# Words that begin a sentence before a name without being part of it.
OPENERS = (
    "a after an and are as at because before both but by can could did do does each every for from had has have how if in is "
    "let on only so since suppose the then to today was were what when where which while who why will with would yesterday"
).split()
# End of fixed values.

# Marks of a name, and of a capitalised word that may be one or begin a sentence.
NAME, EITHER = "\x01", "\x02"
# Readings of an item: words that may be names as they are, as names, and all words as they are.
PLAIN, NAMED, EXACT = 0, 1, 2
# Patterns begin with what rarely fits, as a regular expression is tried at every character.
_EITHER = r"(?=\p{Lu}\p{Ll})(?<![\p{L}\p{N}])"
_NAMES = r"\x02(?<=[\p{L}\p{N},;:)\"']\s{1,3}\x02)"
_INSIDE_NUMBER = r"[.,:/](?<=[0-9][.,:/])(?=[0-9])"
# Between the words of one number or of one name; they make one token.
IN_NUMBER, IN_NAME = "\x04", "\x05"


def _any(words):
    return f"(?:{'|'.join(words)})"


# What follows is looked at first, as it rarely fits: twenty-five, five hundred, hundred (and) five.
_NUMBER_WORDS = (
    rf"(?i)[\s-]{{1,3}}(?:(?={_any(SCALES)}\b)(?<=\b{_any(NUMBERS)}[\s-]{{1,3}})|(?={_any(ONES)}\b)(?<=\b{_any(TENS)}[\s-]{{1,3}})"
    rf"|(?:and\s{{1,3}})?(?={_any(NUMBERS)}\b)(?<=\b{_any(SCALES)}[\s-]{{1,3}}(?:and\s{{1,3}})?))"
)
_NAME_WORDS = rf"\s{{1,3}}\x01(?<=(?:\x01|\x02(?!(?i:{_any(OPENERS)})\b))\p{{L}}{{1,40}}\s{{1,3}}\x01)"


def tokens_of(text: Column) -> Column:
    """The words of a text in lower case, names and words that may be names marked; null has none.

    A number is one word, also in several words (twenty-five, two hundred and five), and so is a name of several words.
    """
    marked = F.translate(F.coalesce(text, F.lit("")), NAME + EITHER + IN_NUMBER + IN_NAME, "    ")
    # A number of several words has one of these; most texts have none.
    low = F.lower(text)
    several = reduce(Column.__or__, [low.contains(word) for word in SCALES + TENS])
    marked = F.when(several, F.regexp_replace(marked, _NUMBER_WORDS, IN_NUMBER)).otherwise(marked)
    for pattern, mark in ((_EITHER, EITHER), (_NAMES, NAME), (_NAME_WORDS, IN_NAME), (_INSIDE_NUMBER, "")):
        marked = F.regexp_replace(marked, pattern, mark)
    return F.array_remove(F.split(F.lower(marked), r"[^\p{L}\p{N}\x01\x02\x04\x05]+", -1), "")


def word_of(token: Column) -> Column:
    """A token without its mark."""
    return F.when(token < F.lit("\x03"), F.substring(token, 2, 1 << 30)).otherwise(token)


def _typed(token):
    """A token, or the placeholder it becomes."""

    def kind(word):
        number = word.isin(NUMBERS) | word.contains(IN_NUMBER)
        return F.when(number, F.lit("<number>")).when(word.isin(UNITS), F.lit("<unit>")).otherwise(word)

    # Most tokens have no mark and begin with a letter, which is behind ":".
    return (
        F.when(token >= F.lit(":"), kind(token)).when(token < F.lit(EITHER), F.lit("<name>"))
        .when(token >= F.lit("0"), F.lit("<number>")).otherwise(kind(word_of(token)))
    )


def template_of(tokens: Column) -> Column:
    """Tokens with placeholders for names, numbers and units; words that may be names stay."""
    return F.transform(tokens, _typed)


def with_names(template: Column, tokens: Column) -> Column:
    """The template of tokens in which words that may be names have become placeholders, too."""
    # Placeholders begin with "<", which is before "=" and all letters.
    return F.zip_with(template, tokens, lambda w, t: F.when((t < F.lit("\x03")) & (w >= F.lit("=")), F.lit("<name>")).otherwise(w))


def _hashes(words):
    return F.transform(words, lambda w: F.xxhash64(w))


def exact_words(tokens: Column) -> Column:
    """The words of tokens as they are, numbers and names of several words apart."""
    words = F.translate(F.array_join(tokens, " "), IN_NUMBER + IN_NAME + NAME + EITHER, "  ")
    return F.array_remove(F.split(words, " ", -1), "")


def _exact_hashes(words):
    """Hashes of the words as they are, other ones than those of templates."""
    return F.transform(words, lambda t: F.xxhash64(F.lit(EXACT), t))


def _window(hashes, size):
    """The hash of the window of ``size`` words at ``pos``, from those of the words; null if there are fewer words."""
    return F.when(F.col("pos") + size <= F.size(hashes), F.xxhash64(*[F.get(hashes, F.col("pos") + i) for i in range(size)]))


def benchmark_windows(items: DataFrame, ids="item_id", text="text", window=WINDOW) -> DataFrame:
    """(item_id, reading, size, place, hash, slots, n_windows) of all windows with enough literal words.

    ``reading`` is ``PLAIN``, or ``NAMED`` with the words that may be names taken as such, if there are any;
    ``slots``: array of (place in the window, placeholder, value). Items with too few literal words somewhere
    have all windows word for word, too: ``EXACT``, without slots.
    """
    rows = items.select(F.col(ids).alias("item_id"), tokens_of(F.col(text)).alias("tokens")).where(F.size("tokens") > 0)
    rows = rows.withColumn("size", F.least(F.size("tokens"), F.lit(window)))
    rows = rows.withColumn("plain", template_of(F.col("tokens"))).withColumn("named", with_names(F.col("plain"), F.col("tokens")))
    readings = (
        rows.withColumn("template", F.col("plain")).withColumn("reading", F.lit(PLAIN))
        .unionByName(rows.where("named <> plain").withColumn("template", F.col("named")).withColumn("reading", F.lit(NAMED)))
    )
    places = F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("size"))).alias("place")
    slots = F.filter(
        F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.struct(
            i.alias("at"),
            F.element_at("template", F.col("place") + i + 1).alias("kind"),
            word_of(F.element_at("tokens", F.col("place") + i + 1)).alias("value"),
        )),
        lambda s: s["kind"].isin("<name>", "<number>", "<unit>"),
    )

    def hashed(words):
        return F.xxhash64(F.slice(words, F.col("place") + 1, F.col("size"))).alias("hash")

    found = readings.select("*", places).select(
        "item_id", "tokens", "reading", "size", "place", hashed(_hashes(F.col("template"))), slots.alias("slots")
    )
    literal = (F.size("tokens") >= MIN_WORDS) & (F.size("slots") <= F.col("size") * (1 - MIN_LITERALS))
    exact = found.where((F.col("reading") == PLAIN) & ~literal).select("item_id", exact_words(F.col("tokens")).alias("tokens")).distinct()
    exact = exact.withColumn("size", F.least(F.size("tokens"), F.lit(window))).select("*", places).select(
        "item_id", F.lit(EXACT).alias("reading"), "size", "place", hashed(_exact_hashes(F.col("tokens"))),
        F.array().cast(found.schema["slots"].dataType).alias("slots"),
    )
    found = found.where(literal).drop("tokens").unionByName(exact)
    totals = found.groupBy("item_id", "reading").agg(F.countDistinct("place").alias("n_windows"))
    totals = totals.select(F.col("item_id").alias("total_id"), F.col("reading").alias("total_of"), "n_windows")
    same = F.col("item_id").eqNullSafe(F.col("total_id")) & (F.col("reading") == F.col("total_of"))
    return found.join(totals, same).drop("total_id", "total_of")


def matched_windows(docs: DataFrame, windows: DataFrame, ids="doc_id", text="text") -> DataFrame:
    """(doc_id, pos, item_id, reading, place, slots, size, n_windows) for every window of an item in a document."""
    small = windows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # At most twice as many as words in a window.
    kinds = sorted(windows.select("size", F.col("reading") == EXACT).distinct().collect())
    words = docs.select(F.col(ids).alias("doc_id"), tokens_of(F.col(text)).alias("tokens"))
    words = words.select("doc_id", "tokens", F.transform("tokens", lambda t: F.xxhash64(_typed(t))).alias("plain"))
    fixed = [F.xxhash64(F.lit(kind)) for kind in ("<number>", "<unit>")]
    named = F.zip_with("plain", "tokens", lambda w, t: F.when((t < F.lit("\x03")) & (w != fixed[0]) & (w != fixed[1]), F.xxhash64(F.lit("<name>"))).otherwise(w))
    hashes = {"plain": F.col("plain"), "named": named, "exact": _exact_hashes(exact_words(F.col("tokens")))}
    kinds = kinds or [(WINDOW, False)]
    used = [reading for reading in hashes if any((reading == "exact") == exact for _, exact in kinds)]
    rows = words.select("doc_id", *[hashes[reading].alias(reading) for reading in used])
    # A row for each place: compiled code reads the arrays there, and builds none for a window.
    most = reduce(lambda a, b: F.greatest(a, b), [F.size(reading) for reading in used])
    rows = rows.select("*", F.explode(F.when(most > 0, F.sequence(F.lit(0), most - 1))).alias("pos"))
    at, found = [], []
    for size, exact in kinds:
        at += [_window(reading, size).alias(f"{reading}_{size}") for reading in (["exact"] if exact else ["plain", "named"])]
        # A window that is the same in both readings meets an item once.
        found += [F.col(f"exact_{size}")] if exact else [
            F.col(f"plain_{size}"), F.when(F.col(f"named_{size}") != F.col(f"plain_{size}"), F.col(f"named_{size}"))
        ]
    rows = rows.select("doc_id", "pos", *at).select("doc_id", "pos", F.explode(F.array(*found)).alias("hash"))
    return rows.where("hash is not null").join(F.broadcast(windows) if small else windows, "hash").drop("hash")


def inconsistent(docs: DataFrame, matched: DataFrame, ids="doc_id", text="text") -> DataFrame:
    """(doc_id, item_id, reading, shift) of occurrences in which a slot value of the item has two partners.

    Names and units of the document have one partner, too; two numbers may become equal. An occurrence is
    an item at one shift between its places and the document's.
    """
    slotted = matched.where(F.size("slots") > 0).select("doc_id", "item_id", "reading", "pos", (F.col("pos") - F.col("place")).alias("shift"), F.explode("slots").alias("slot"))
    wanted = slotted.select("doc_id", "item_id", "reading", "shift", (F.col("pos") + F.col("slot.at")).alias("at"), F.col("slot.kind").alias("kind"), F.col("slot.value").alias("value")).distinct()
    by_doc = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "reading", "shift", "at", "kind", "value")).alias("wanted"))
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        by_doc = F.broadcast(by_doc)
    rows = docs.select(F.col(ids).alias("id"), F.col(text).alias("text")).join(by_doc, F.col("id").eqNullSafe(F.col("doc_id")))
    rows = rows.select("doc_id", tokens_of(F.col("text")).alias("tokens"), "wanted").withColumn("template", with_names(template_of(F.col("tokens")), F.col("tokens")))
    seen = rows.select("doc_id", "tokens", "template", F.explode("wanted").alias("w"))
    # Another row with the same id has something else at this place.
    seen = seen.where(F.try_element_at("template", F.col("w.at") + 1) == F.col("w.kind"))
    pairs = seen.select("doc_id", "w.item_id", "w.reading", "w.shift", "w.kind", "w.value", word_of(F.element_at("tokens", F.col("w.at") + 1)).alias("other")).distinct()
    # Counted both ways, so the texts are taken apart once.
    pairs = stored(pairs, "pairs")
    keys = ["doc_id", "item_id", "reading", "shift"]
    there = pairs.groupBy(*keys, "kind", "value").agg(F.count("*").alias("n"))
    back = pairs.where("kind <> '<number>'").groupBy(*keys, "kind", "other").agg(F.count("*").alias("n"))
    return there.where("n > 1").select(*keys).unionByName(back.where("n > 1").select(*keys)).distinct()


def contaminated(
    docs: DataFrame, items: DataFrame, ids="doc_id", text="text", item_ids="item_id", item_text="text", coverage=COVERAGE
) -> DataFrame:
    """(doc_id, item_id, n_windows, n_found, coverage, first_word) for each document and item it holds.

    At least ``coverage`` of the item's windows are in the document, in occurrences with consistent slots;
    ``first_word`` is the first of them, in tokens of ``tokens_of`` from 0 (found word for word: in words). The best reading of the item counts. Null and empty
    texts match nothing; items of fewer than five words are found word for word. Rows that share an id count as one document, null ids as another; items that
    share an id count as one. Extra columns do not matter; empty tables give an empty one.
    """
    windows = stored(benchmark_windows(items, item_ids, item_text), "windows")
    matched = stored(matched_windows(docs, windows, ids, text), "matched").withColumn("shift", F.col("pos") - F.col("place"))
    bad = inconsistent(docs, matched, ids, text).select(*[F.col(c).alias(f"bad_{c}") for c in ("doc_id", "item_id", "reading", "shift")])
    same = F.lit(True)
    for c in ("doc_id", "item_id", "reading", "shift"):
        same = same & F.col(c).eqNullSafe(F.col(f"bad_{c}"))
    good = matched.join(bad, same, "left_anti")
    # Windows of a template may be found in either reading; those with names count by themselves, too.
    totals = windows.groupBy("item_id", "reading").agg(F.max("n_windows").alias("n_windows"))
    both = F.when(F.col("reading") == NAMED, F.array(F.lit(PLAIN), F.lit(NAMED))).otherwise(F.array("reading"))
    by_reading = good.select("doc_id", "item_id", "place", "pos", F.explode(both).alias("reading"))
    places = by_reading.groupBy("doc_id", "item_id", "reading", "place").agg(F.min("pos").alias("pos"))
    found = places.groupBy("doc_id", "item_id", "reading").agg(F.count("*").alias("n_found"), F.min("pos").cast("long").alias("first_word"))
    totals = totals.select(F.col("item_id").alias("total_id"), F.col("reading").alias("total_of"), "n_windows")
    same = F.col("item_id").eqNullSafe(F.col("total_id")) & (F.col("reading") == F.col("total_of"))
    share = F.col("n_found") / F.col("n_windows")
    best = found.join(totals, same).groupBy("doc_id", "item_id").agg(
        F.max(F.struct(share.alias("coverage"), (-F.col("reading")).alias("order"), "n_windows", "n_found", "first_word")).alias("best")
    )
    return best.where(F.col("best.coverage") >= coverage).select("doc_id", "item_id", "best.n_windows", "best.n_found", "best.coverage", "best.first_word")


def without_contaminated(docs: DataFrame, items: DataFrame, ids="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with the columns of ``docs``."""
    key = unused(docs, "contaminated_id")
    found = contaminated(docs, items, ids, text).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(found, docs[ids].eqNullSafe(F.col(key)), "left_anti")
