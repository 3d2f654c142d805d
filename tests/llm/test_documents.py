"""Operators on document tables, against plain Python, with the odd cases of every column."""

import hashlib

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import bpe, catalog, lines, ngrams, simhash, templates, toxicity
from tallyspark.llm.components import connected_components
from tallyspark.llm.texts import words_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, score string, n_lines int, fp string, _toxic int"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y", 0) for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two"), (5, "One two"), (None, "a b c d e f"), (7, "a b c d e f"), (8, "z " * 30_000)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_against_all_pairs(spark, given):
    rows = catalog.QUERIES["op3_simhash"](spark, SF).collect()
    prints = {d: brute.fingerprint(t) for d, t in given}
    want = brute.components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {d: (prints[d], want[d]) for d in prints}


def test_simhash_links_fingerprints_of_any_distance(spark):
    random = np.random.default_rng(3)
    base = random.integers(0, 1 << 63, 60, dtype=np.uint64)
    prints = set()
    for b in base.tolist():
        for flips in (0, 1, 2, 3, 3, 4):
            bits = random.choice(64, flips, replace=False)
            prints.add(b ^ sum(1 << int(k) for k in bits))
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for bits in (4, 9):
        found = connected_components(simhash.links(frame, bits))
        label = {r.node % (1 << 64): r.label % (1 << 64) for r in found.collect()}
        want = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
        groups, mine = {}, {}
        for p in prints:
            groups.setdefault(want[p], set()).add(p)
            mine.setdefault(label.get(p, p), set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_simhash_of_odd_rows(spark):
    rows = simhash.near_duplicates(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert found[1] == found[2] == found[3] == ("0" * 16, 1)
    assert found[None] == found[7] and found[7][1] == 7
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    kept = simhash.one_of_each(documents(spark, ODD))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 7, 8] and kept.columns == documents(spark, []).columns


def test_fingerprint_hashes_as_spark_does(spark):
    one = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert simhash.simhash("A b\tC") == one % (1 << 64)


def test_bpe_equals_the_library(spark, given):
    from tokenizers import Tokenizer

    path = catalog.tokenizer_file()
    library = Tokenizer.from_file(path)
    odd = ["", " ", "ΟΔΟΣ Σ", "don't WE'LL <|endoftext|>x<|startoftext|> <|endoftext", "İstanbul ﬁ ẞ é 한국어", "a" * 5000, "x\u0085y\x1cz w", "😀👍🏽", "\x00"]
    texts = [t for _, t in given[:60]] + odd
    frame = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)] + [(None, None, 4)], "doc_id long, text string, ids int")
    rows = {r.doc_id: r for r in bpe.encode_documents(frame, path).collect()}
    digests = {r.doc_id: r for r in bpe.digest(bpe.encode_documents(frame, path)).collect()}
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bytes(rows[i].ids), "<u4").tolist() == want, text[:50]
        assert rows[i].decoded == library.decode(want, skip_special_tokens=False) and rows[i].n_tokens == len(want)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(rows[i].decoded.encode()).hexdigest()
    assert rows[None].n_tokens == 0 and rows[None].decoded == ""
    assert bpe.encode_documents(frame.limit(0), path).count() == 0


def test_merges_take_the_leftmost_of_the_lowest_rank():
    random = np.random.default_rng(1)
    for _ in range(300):
        ranks = {}
        for rank in range(30):
            a, b = (int(x) for x in random.integers(0, 6 + rank, 2))
            ranks.setdefault((a, b), (rank, 6 + rank))
        symbols = [int(x) for x in random.integers(0, 6, random.integers(0, 40))]
        want = list(symbols)
        while True:
            pairs = [(ranks[p][0], i) for i, p in enumerate(zip(want, want[1:])) if p in ranks]
            if not pairs:
                break
            _, i = min(pairs)
            want[i : i + 2] = [ranks[want[i], want[i + 1]][1]]
        assert bpe.merge(symbols, ranks) == want


def test_line_dedup_against_all_pairs(spark):
    random = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(30)]
    base = [[str(x) for x in random.choice(vocabulary, n)] for n in (5, 6, 7, 8, 9, 11, 12, 13, 16, 130)]
    docs = []
    for d in range(60):
        text = []
        for _ in range(4):
            w = list(base[random.integers(len(base))])
            for _ in range(random.integers(0, 3)):
                i, kind = random.integers(len(w)), random.integers(3)
                w[i : i + (kind != 1)] = [] if kind == 0 else [str(random.choice(vocabulary))]
            text.append(str(random.choice([" ", "  ", "\t"])).join(w) + str(random.choice(["", " ", "\r"])))
        docs.append((d, "\n".join(text)))
    want = brute.removed_lines(docs)
    rows = {r.doc_id: r for r in lines.dedupe_lines(documents(spark, docs)).collect()}
    assert {d: r.removed for d, r in rows.items()} == want and any(want.values())
    for d, t in docs:
        assert rows[d].text == "\n".join(x for p, x in enumerate(t.split("\n")) if p not in set(want[d]))


def test_line_dedup_of_given_documents(spark, given):
    rows = {r.doc_id: r.removed for r in catalog.QUERIES["op7_lines"](spark, SF).collect()}
    assert rows == brute.removed_lines(given)


def test_line_dedup_of_odd_rows(spark):
    frame = documents(spark, [*ODD, (9, "A b c d e f\nshort\n\na b c d E f"), (9, "A b c d e f\nshort\n\na b c d E f")])
    rows = lines.dedupe_lines(frame).collect()
    assert len(rows) == frame.count()
    found = {r.doc_id: r for r in rows}
    assert found[1].text is None and found[1].n_lines == 0 and found[2].text == "" and found[2].n_lines == 1
    assert found[None].text == "a b c d e f" and found[7].text == "" and found[8].removed == []
    assert found[9].removed == [0, 3] and found[9].text == "short\n"
    assert lines.dedupe_lines(documents(spark, [])).count() == 0
    kept = lines.without_repeated(frame)
    assert {r.n_lines for r in kept.collect()} == {1}
    assert kept.columns == frame.columns and 7 not in {r.doc_id for r in kept.collect()}
    with pytest.raises(ValueError):
        lines.numbered_lines(frame, min_words=4)


QUESTION = "John has 12 apples and Mary gives him 7 more apples. How many apples does John have now in total?"


def test_templates_find_other_numbers_and_names_but_not_mixed_up_ones(spark):
    items = spark.createDataFrame([(1, QUESTION, 0), (2, None, 0), (3, "too short", 0), (4, "", 0)], "item_id long, text string, doc_id int")
    docs = documents(spark, [
        *ODD,
        (11, "Once: " + QUESTION.replace(" ", " \n").replace("apples", "APPLES")),
        (12, "x y z. Peter has 1,500 apples and Anna gives him 3.5 more apples. How many apples does Peter have now in total? Bye."),
        (13, "Peter has 15 apples and Anna gives him 3 more apples. How many apples does Anna have now in total?"),
        (14, QUESTION[: len(QUESTION) // 3]),
        (None, QUESTION),
        (15, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"),
    ])
    rows = templates.contaminated(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 1), (11, 1), (12, 1)]
    assert templates.contaminated(docs, items.limit(0)).count() == 0 and templates.contaminated(docs.limit(0), items).count() == 0
    kept = templates.without_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id and r.doc_id > 10) == [13, 14, 15] and kept.columns == docs.columns


def test_templates_find_whole_items_of_given_documents(spark, given):
    def plain(text):
        return f" {' '.join(''.join(c if c.isalnum() else ' ' for c in text.lower()).split())} "

    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in given for i, x in items if x in plain(t)}
    assert {(r.doc_id, r.item_id) for r in catalog.QUERIES["op2_templates"](spark, SF).collect()} == want


def test_ngram_scores_against_plain_counts(spark, given, monkeypatch):
    monkeypatch.setattr(ngrams, "CHARACTERS_PER_SHARD", 60_000)
    monkeypatch.setattr(ngrams, "TOKENS_PER_BLOCK", 20_000)
    weights = (ngrams.TRIGRAM, ngrams.BIGRAM, ngrams.UNIGRAM)
    want = brute.ngram_scores(given, *weights)
    rows = ngrams.score(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert len(rows) == len(given)
    for r in rows:
        out, n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert abs(r.base_score - base) < 1e-9 * abs(base) and abs(r.score - score) < 1e-3 * n


@pytest.mark.parametrize("limit", [1, 40, 1_000_000])
def test_ngram_blocks_hold_the_words_of_any_slice(monkeypatch, limit):
    monkeypatch.setattr(ngrams, "TOKENS_PER_BLOCK", limit)
    monkeypatch.setattr(ngrams, "BYTES_PER_PIECE", limit)
    texts = [" A b\x0b\x0cc\td\r\n", "", None, "\x1c \x85y\xa0 É\u2003ß", "Zz zZ\x00 日本 b", "x" * 50, " "] * 5
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([None, *range(1, 35)], pa.int64()), "text": pa.array(texts)})
    ids, found = [], []
    for docs, out, sizes, tokens, hashes in ngrams._blocks(iter([batch.slice(0, 9), batch.slice(9, 0), batch.slice(9)])):
        ids += docs
        assert out.tolist() == [ngrams.held_out(d) for d in docs]
        found += [hashes[x].tolist() for x in np.split(tokens, np.cumsum(sizes)[:-1])]
    assert ids == batch.column(0).to_pylist()
    assert found == [[xxhash.xxh64_intdigest(w, ngrams.SEED) >> 1 for w in [*words_of(t), ngrams.END]] for t in texts]


def test_ngram_scores_of_odd_rows(spark):
    rows = ngrams.score(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    found = {r.doc_id: r for r in rows}
    assert found[1].n_tokens == found[2].n_tokens == 1 and found[8].n_tokens == 30_001
    assert all(r.score < 0 for r in rows)
    assert ngrams.score(documents(spark, [])).count() == 0
    held = ngrams.score(documents(spark, [(d, "a b") for d in range(200) if ngrams.held_out(d)])).collect()
    assert held and all(r.train_tokens == 0 and r.n_known == 0 for r in held)


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = catalog.QUERIES["op4_toxicity"](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    found = rows.join(labels, "doc_id").select("predicted", "toxic").toPandas()
    hit = int(((found.predicted == 1) & (found.toxic == 1)).sum())
    assert hit >= 0.75 * found.toxic.sum() and hit >= 0.85 * found.predicted.sum()


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark, [*ODD, *((100 + i, f"you are an idiot {i}" if i % 2 else f"nice day number {i}") for i in range(80))])
    labels = spark.createDataFrame([(100 + i, i % 2, "z") for i in range(80)] + [(None, 1, "z"), (1, None, "z"), (2, 0, "z"), (2, 1, "z")], "doc_id long, toxic int, text string")
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id and r.doc_id >= 100)
    assert toxicity.classify(docs, labels.limit(0)).where("abs(score - 0.01) > 1e-9").count() == 0
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and all(r.doc_id % 2 == 0 for r in kept.collect() if r.doc_id and r.doc_id >= 100)


def test_templates_find_names_at_sentence_starts(spark):
    texts = {1: "Tom has 5 apples. Tom buys 3 more apples. How many apples does Tom have?", 2: "Tom buys 12 pears for 3 dollars each."}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    docs = documents(spark, [
        (1, "Well. " + texts[1].replace("Tom", "Anna").replace("5", "6").replace("3", "4")), (2, "So: Anna buys 7 pears for 20 cents each. Yes."), (3, texts[1]), (4, texts[2]),
        (5, "Anna has 6 apples. Peter buys 4 more apples. How many apples does Mary have?"), (6, "Yesterday Anna buys 7 pears for 20 cents each."),
    ])
    assert sorted((r.doc_id, r.item_id) for r in templates.contaminated(docs, items).collect()) == [(1, 1), (2, 2), (3, 1), (4, 2), (6, 2)]


def test_templates_find_any_item_word_for_word(spark):
    texts = {
        1: "What is 12 + 35 + 7 + 90 + 4?", 2: "Convert 3 km", 3: "Ada Lovelace, Alan Turing, Grace Hopper, Kurt Gödel and Emmy Noether", 4: "5 7",
        5: "A sentence of plain words that goes on for a while: 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18",
    }
    items = spark.createDataFrame([*texts.items(), (6, "?!"), (7, None)], "item_id long, text string")
    docs = documents(spark, [
        *((i, f"Some words before. {t} And behind.") for i, t in texts.items()), (11, "What is 13 + 35 + 7 + 90 + 4?"), (12, "Convert 4 km"),
        (13, "all of 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 again"), (None, None), (14, ""),
    ])
    assert sorted((r.doc_id, r.item_id) for r in templates.contaminated(docs, items).collect()) == [(i, i) for i in texts] + [(13, 5)]


def test_short_lines_that_repeat_exactly_go(spark):
    frame = documents(spark, [(1, "of, edti oner.\n\nsome more words of the first one\nYes."), (2, "Of,  EDTI oner.\n\nand other words that the second has\nof, edti"), (3, "other text here that is its own line\nyes.\n \n\n")])
    rows = {r.doc_id: r for r in lines.dedupe_lines(frame, short=True).collect()}
    assert {d: r.removed for d, r in rows.items()} == {1: [], 2: [0], 3: [1]}
    assert {r.doc_id: r.text for r in lines.without_repeated(frame).collect()} == {d: r.text for d, r in rows.items()}


def test_own_text_of_a_mostly_repeated_document_stays(spark):
    shared = "\n".join(f"line {i} of the passage that both documents have {i * i}" for i in range(40))
    own = "and these words only the second document has"
    kept = lines.without_repeated(documents(spark, [(1, shared), (2, f"{shared}\n{own}\n"), (3, f"\n{shared}\n \t\n"), (4, " \n")]))
    assert {r.doc_id: r.text for r in kept.collect()} == {1: shared, 2: f"{own}\n", 4: " \n"}


def test_lines_of_more_than_64_words(spark):
    words = [f"w{i}" for i in range(130)]
    swapped = list(words)
    swapped[3], swapped[67] = swapped[67], swapped[3]
    near = list(words)
    near[100] = "other"
    docs = [(1, " ".join(swapped)), (2, " ".join(words)), (3, " ".join(near)), (4, " ".join(words[:60] + words[61:]))]
    random = np.random.default_rng(4)
    for k in range(40):
        base = [f"x{v}" for v in random.integers(0, 30, int(random.integers(65, 400)))]
        docs.append((10 + 3 * k, " ".join(base)))
        place, other = (int(v) for v in random.choice(len(base), 2, replace=False))
        for n in (1, 2):
            copy = list(base)
            if k % 3 == 0:
                copy[place] = f"y{n}"
            elif k % 3 == 1:
                del copy[place]
            else:
                copy[place], copy[other] = copy[other], copy[place]
            docs.append((10 + 3 * k + n, " ".join(copy)))
    rows = lines.dedupe_lines(documents(spark, docs)).collect()
    assert {r.doc_id: r.removed for r in rows} == brute.removed_lines(docs)
    assert {r.doc_id: r.removed for r in rows}[3] == [0]


def test_what_bpe_remembers_changes_nothing(spark, given):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(catalog.tokenizer_file())
    texts = [t or "" for _, t in given[:60]] + ["", " ", "\n", "<|endoftext|>x <|startoftext|>", "word" * 30_000, "ordinary text, and more of it. " * 40_000]
    for remembered in (4, 100, 400_000):
        mine = bpe.Tokenizer(catalog.tokenizer_file(), remembered)
        for text in texts:
            ids, decoded = mine.encode(text)
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want and decoded == library.decode(want, skip_special_tokens=False)
            assert mine.decode(ids) == decoded
        assert len(mine.known) + len(mine.known.old) <= remembered
