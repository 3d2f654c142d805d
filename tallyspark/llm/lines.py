"""Line dedup across documents by a deletion-neighbourhood join.

Lines of at least five words count as equal up to one word replaced, added or left out,
so four fifths of five words agree at least, and more of longer lines: two changed words of
50 are too many (the README has figures). The earliest line stays, in the order of
document ids and lines; a line goes if any earlier line is within the bound.

Equal lines meet by a 128-bit hash, on request those of fewer words as well. For near ones, every line emits its variants with one
word deleted as hashed keys: equal variants with the gap at the same place are one
replacement apart, and a variant that equals a whole line is one word longer. A key keeps
its earliest line only, which every other line of the key is verified against, so no group
is spelt out as pairs. One edit leaves half of a line as it was: lines that share no half
with another text cannot have a partner and emit nothing.
All of it is DataFrame functions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.texts import unused
from tallyspark.session import stored

MIN_WORDS = 5
BLANKS = " \t\x0b\f\r"
# Rows of one number each that may be broadcast: some tens of MB. Larger tables are shuffled.
BROADCAST_ROWS = 1_000_000


def words_of(line: Column) -> Column:
    """The words of a line in lower case; a blank line has one empty word."""
    return F.split(F.btrim(F.lower(line), F.lit(BLANKS)), f"[{BLANKS}]+")


def _half_keys(words):
    """Hashes of the first and the last words of a line, of which one survives any single edit.

    The length of a half steps by two words at every fourth word, and lines at a step also emit the
    half below, so that lines whose lengths differ by one share a length.
    """
    n = F.size(words)
    half = F.floor(n / 4).cast("int") * 2

    def keys(length):
        first = F.xxhash64(F.lit("first"), length, F.slice(words, F.lit(1), length))
        last = F.xxhash64(F.lit("last"), length, F.slice(words, n - length + 1, length))
        return first, last

    lower = F.greatest(half - 2, F.lit(1))
    below = [F.when((n % 4 == 0) & (half > 2), key) for key in keys(lower)]
    return F.array_compact(F.array(*keys(half), *below))


def numbered_lines(docs: DataFrame, ids="doc_id", text="text", min_words=MIN_WORDS, short=False) -> DataFrame:
    """(doc_id, pos, h1, h2) and the half keys of every line of enough words; ``short``: of all lines but blank ones, others without keys."""
    if min_words < MIN_WORDS:
        raise ValueError(f"one word of fewer than {MIN_WORDS} is more than a fifth of a line")
    lines = docs.select(F.col(ids).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"))
    words = F.col("words")
    enough = F.size(words) >= min_words
    halves = F.when(enough, _half_keys(words)).alias("halves") if short else _half_keys(words).alias("halves")
    return (
        lines.select("doc_id", "pos", words_of(F.col("line")).alias("words"))
        .where(words[0] != "" if short else enough)
        .select("doc_id", "pos", F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(1), words).alias("h2"), halves)
    )


def first_places(lines: DataFrame) -> DataFrame:
    """One row per different line: (h1, h2, place: the earliest (doc_id, pos))."""
    return lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "pos")).alias("place"))


def _small(frame):
    """``frame``, to be broadcast if it has few rows; they are a few numbers each."""
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def with_possible_partner(lines: DataFrame, places: DataFrame) -> DataFrame:
    """The places of the lines that share a half with a different line."""
    keys = lines.select("h1", "h2", F.explode("halves").alias("half"))
    shared = stored(keys.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("half"), "shared")
    wanted = keys.join(_small(shared), "half", "left_semi").select("h1", "h2").distinct()
    return places.join(wanted, ["h1", "h2"], "left_semi")


def _fetch(docs, wanted, ids, text):
    """(line, h1, h2, place, words) of the lines at the wanted places; ``line`` numbers them in the order of places."""
    by_doc = wanted.groupBy("place.doc_id").agg(F.collect_list(F.struct("place.pos", "h1", "h2")).alias("wanted"))
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        by_doc = F.broadcast(by_doc)
    rows = docs.select(F.col(ids).alias("id"), F.split(F.col(text), "\n", -1).alias("lines"))
    found = rows.join(by_doc, F.col("id").eqNullSafe(F.col("doc_id"))).select("doc_id", "lines", F.explode("wanted").alias("w"))
    words = words_of(F.try_element_at("lines", F.col("w.pos") + 1))
    found = found.select(
        F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"), F.struct("doc_id", F.col("w.pos").alias("pos")).alias("place"), words.alias("words")
    )
    # Rows that share an id have other lines at the same place.
    found = found.where((F.xxhash64("words") == F.col("h1")) & (F.xxhash64(F.lit(1), F.col("words")) == F.col("h2"))).dropDuplicates(["h1", "h2"])
    # Sorted ranges of places get rising numbers; the table is written before they are used.
    return found.repartitionByRange("place").sortWithinPartitions("place").withColumn("line", F.monotonically_increasing_id())


def variant_keys(lines: DataFrame) -> DataFrame:
    """(line, n, i, rest, whole) for each word i of lines (line, words) of n words: hashes without the word, and of all.

    A line's hash is the exclusive or of the hashes of its words with their places. Without word i it is that of the
    words before, and that of the words behind with their places less one. With x and y the hashes of a word at its
    place and at the one before, that is the running exclusive or of both up to word i, the whole of y, and
    word i's own x.
    """
    marks = lines.select("line", F.size("words").alias("n"), F.posexplode("words").alias("i", "word")).selectExpr(
        "line", "n", "i", "xxhash64(word, i) as x", "xxhash64(word, i - 1) as y"
    )
    line = Window.partitionBy("line")
    summed = marks.withColumns({
        "whole": F.bit_xor("x").over(line),
        "behind": F.bit_xor("y").over(line),
        "upto": F.bit_xor(F.col("x").bitwiseXOR(F.col("y"))).over(line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    return summed.selectExpr("line", "n", "i", "upto ^ x ^ behind as rest", "whole")


def earliest_partners(variants: DataFrame) -> DataFrame:
    """(line, other): the earliest line that meets a line in a variant, where that is earlier.

    Variants without word i meet at the same i: one word replaced. A variant that is a whole line meets it: one
    word left out. A key keeps its earliest line, or its earliest whole and earliest longer one.
    """
    replaced = variants.select(F.xxhash64("rest", "n", "i").alias("key"), "line")
    least = replaced.groupBy("key").agg(F.min("line").alias("other"), F.max("line").alias("last")).where("other < last").select("key", "other")
    met = replaced.join(_small(stored(least, "replaced")), "key").select("line", "other")
    whole = variants.where("i = 0").select(F.xxhash64("whole", "n").alias("key"), F.col("line").alias("whole_line"))
    longer = variants.select(F.xxhash64("rest", F.col("n") - 1).alias("key"), "line").join(_small(whole), "key")
    longer = stored(longer.select("line", "whole_line"), "longer")
    met = met.unionByName(longer.select("line", F.col("whole_line").alias("other")))
    met = met.unionByName(longer.select(F.col("whole_line").alias("line"), F.col("line").alias("other")))
    return met.where("other < line").groupBy("line").agg(F.min("other").alias("other"))


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two lists of words differ by at most one word replaced, added or left out."""
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))

    def common(x, y):
        first = F.array_position(F.zip_with(F.slice(x, F.lit(1), shorter), F.slice(y, F.lit(1), shorter), lambda v, w: v == w), False)
        return F.when(first == 0, shorter).otherwise(first - 1)

    return (longer - shorter <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1)


def removed_lines(docs: DataFrame, ids="doc_id", text="text", min_words=MIN_WORDS, short=False) -> DataFrame:
    """(doc_id, pos) of every line that has an earlier equal or near line, lines counted from 0; ``short``: equal lines of any length."""
    lines = stored(numbered_lines(docs, ids, text, min_words, short), "lines")
    places = stored(first_places(lines), "places")
    candidates = stored(with_possible_partner(lines, places), "candidates")
    words = stored(_fetch(docs, candidates, ids, text), "words")
    pairs = earliest_partners(stored(variant_keys(words), "variants"))
    there = words.select(F.col("line").alias("other"), F.col("words").alias("other_words"))
    near = (
        pairs.join(words.select("line", "h1", "h2", "words"), "line").join(there, "other")
        .where(within_one_edit(F.col("words"), F.col("other_words"))).select("h1", "h2")
    )
    kept = places.join(near, ["h1", "h2"], "left_anti").select(F.col("place.doc_id").alias("kept_id"), F.col("place.pos").alias("kept_pos"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("pos") == F.col("kept_pos"))
    return lines.select("doc_id", "pos").join(kept, same, "left_anti").distinct()


def _let(value, use):
    """``use(value)`` with the value computed once, also where the optimizer would repeat it for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _without(lines, gone):
    """The lines (an array) but for the places ``gone``, joined again."""

    def begin(k):
        return F.when(k == 0, F.lit(0)).otherwise(F.try_element_at(gone, F.greatest(k, F.lit(1))) + 1)

    def stretch(k):
        end = F.coalesce(F.try_element_at(gone, k + 1), F.size(lines))
        return F.slice(lines, begin(k) + 1, end - begin(k))

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch)), "\n")


def _with_rest(docs, ids, text, min_words, short=False):
    """``docs`` with two columns of new names: the text without the removed lines, and their places."""
    rest, gone, key = (unused(docs, name) for name in ("rest", "gone", "removed_id"))
    removed = stored(removed_lines(docs, ids, text, min_words, short), "removed")
    few = removed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    removed = removed.groupBy(F.col("doc_id").alias(key)).agg(F.sort_array(F.collect_list("pos")).alias(gone))
    if few:
        removed = F.broadcast(removed)
    joined = docs.join(removed, docs[ids].eqNullSafe(F.col(key)), "left").drop(key)

    def known(lines):
        # Rows that share an id may have fewer lines than others of it.
        return _let(F.size(lines), lambda n: F.filter(F.coalesce(gone, F.array().cast("array<int>")), lambda p: p < n))

    split = F.split(F.col(text), "\n", -1)
    left = _let(split, lambda lines: _let(known(lines), lambda places: _without(lines, places)))
    return (
        joined.withColumn(rest, F.when(F.size(gone) > 0, left).otherwise(F.col(text)))
        .withColumn(gone, F.when(F.size(gone) > 0, known(split)).otherwise(F.array().cast("array<int>"))),
        rest,
        gone,
    )


def dedupe_lines(docs: DataFrame, ids="doc_id", text="text", min_words=MIN_WORDS, short=False) -> DataFrame:
    """``docs`` with its own columns, ``text`` without the removed lines, and n_lines, removed (places of removed lines).

    Lines end at a line feed, words at ASCII white space, upper and lower case are the same. Lines of fewer
    than ``min_words`` words stay, or with ``short`` go if an earlier one is equal. A null text stays null with no lines; other texts keep their order of lines. A row
    with a null id comes before all others. Rows that share an id share their removed places. An
    empty table gives an empty table; columns named n_lines or removed are replaced.
    """
    joined, rest, gone = _with_rest(docs.drop("n_lines", "removed"), ids, text, min_words, short)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n", -1))).cast("long")
    return joined.withColumns({"n_lines": n_lines, text: F.col(rest), "removed": F.col(gone)}).drop(rest, gone)


def digest(deduped: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return deduped.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed", "text")


def without_repeated(docs: DataFrame, ids="doc_id", text="text", length="n_chars") -> DataFrame:
    """``docs`` without repeated lines, short ones too, with its own columns; a column ``length`` is counted anew.

    A document goes as a whole only if lines were removed and nothing but blank ones is left. Null and empty texts stay.
    """
    joined, rest, gone = _with_rest(docs, ids, text, MIN_WORDS, short=True)
    kept = joined.where((F.size(gone) == 0) | F.col(rest).rlike(f"[^\n{BLANKS}]"))
    columns = {text: F.col(rest)}
    if length in docs.columns:
        columns[length] = F.length(rest).cast(docs.schema[length].dataType)
    return kept.withColumns(columns).select(*docs.columns)
