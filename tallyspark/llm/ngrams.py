"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model is a trigram model by pooled counts. For word w after u v, with training counts c,

    P(w | u v) = (A c(u v w) + B c(v w) + M P(w)) / (A c(u v) + B c(v) + M),

where P(w) is the smoothed unigram of the base score; it sums to one over all words and the
unknown one. Its logarithm is a term that needs the counts of one word w and the words before
it, less a term that needs the same counts of the word before. So tokens are dealt out by word:
a shard holds all n-grams that end in its words, as a trie read from the last word back, and
adds up the terms of every occurrence by document. Nothing is looked up across shards, and
no table of words or n-grams is broadcast or collected; the number of shards grows with the text.

Two passes: the first counts words (for the totals, and for the few that are so frequent that
a shard would overflow; their n-grams are dealt out by the word before, too), the second
builds the tries and scores.
"""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.elias_fano import Trie
from tallyspark.session import stored

# Weights of the trigram and the bigram counts, and of the unigram.
TRIGRAM, BIGRAM, UNIGRAM = 100.0, 1.0, 1000.0
# Base: added to every count.
ADDED = 0.1
HELD_OUT = 10
# Characters of text for each shard; a shard takes some tens of bytes of memory for each of its tokens.
CHARACTERS_PER_SHARD = 10_000_000
# Tokens that a task turns into one set of parcels, one for each shard.
TOKENS_PER_BLOCK = 1_500_000
# Bytes of text that a task cuts into words at a time.
BYTES_PER_PIECE = 1_500_000
# A word with more than this share of a shard's tokens is dealt out by the word before, too.
FREQUENT = 1 / 8

# Hashes of the end and of the start, whose strings no word can be.
END, START = b"", b" "
# End of fixed values.
SEED = 7


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT == 0


def _pieces(batch):
    """A batch in slices of so many bytes of text, at least a row each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(lengths, dtype=np.int64) // BYTES_PER_PIECE
    cuts = np.r_[0, np.flatnonzero(np.diff(piece)) + 1, len(piece)] if len(piece) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _split(text):
    """The words of an array of texts as numbers, one text behind the other, the words numbered, and how many each text has; as ``words_of`` has them."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    words = parts.flatten()
    full = pc.binary_length(words).to_numpy() > 0
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), pc.list_value_length(parts).to_numpy())
    coded = words.filter(pa.array(full)).dictionary_encode()
    # Offsets of 64 bits, as words of many texts are joined. (A slice must not be cast before it is lower-cased: Arrow 23 misreads it.)
    return coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary()), np.bincount(owner[full], minlength=len(parts))


def _blocks(batches):
    """(doc ids, held out, tokens per document, numbers of all tokens with ends, 63-bit hash of each number)."""
    docs, parts, total = [], [], 0

    def done():
        # Words of a piece have numbers of their own, which become those of the block.
        coded = pa.concat_arrays([words for _, words, _ in parts]).dictionary_encode()
        words = coded.dictionary.to_pylist()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, itertools.chain([END], words), itertools.repeat(SEED)), dtype=np.uint64, count=len(words) + 1)
        sizes = np.concatenate([count for _, _, count in parts]).astype(np.int64) + 1
        # Number 0 is the end, which is the last token of each document.
        tokens = np.zeros(sizes.sum(), dtype=np.uint32)
        word = np.ones(len(tokens), dtype=bool)
        word[np.cumsum(sizes) - 1] = False
        number = (coded.indices.to_numpy() + 1).astype(np.uint32)
        starts = np.r_[0, np.cumsum([len(words) for _, words, _ in parts])]
        tokens[word] = np.concatenate([number[start:][own] for start, (own, _, _) in zip(starts, parts)])
        return docs, np.array([held_out(d) for d in docs], dtype=bool), sizes, tokens, hashes >> np.uint64(1)

    for batch in batches:
        for piece in _pieces(batch):
            parts.append(_split(piece.column(1)))
            docs += piece.column(0).to_pylist()
            total += len(parts[-1][0]) + len(parts[-1][2])
            if total >= TOKENS_PER_BLOCK:
                block, docs, parts, total = done(), [], [], 0
                # What Arrow keeps would stand beside the sorting.
                pa.default_memory_pool().release_unused()
                yield block
    if docs:
        yield done()


def _bits(numbers):
    return max(1, int(numbers.max()).bit_length()) if len(numbers) else 1


def _numbered(keys):
    """For each of sorted keys, how many different ones come before it."""
    return np.cumsum(np.r_[False, keys[1:] != keys[:-1]], dtype=np.uint64)[: len(keys)]


def _ordered(high, before, stable=False):
    """Where rows sorted by (high, before) come from. The bits of ``high`` and of the number of rows are at most 64 together.

    Both keys fill one of 64 bits but for the last bits of ``before``, by which equal ones are sorted again.
    """
    bits = np.uint64(_bits(high))
    key = high.astype(np.uint64)
    key <<= np.uint64(64) - bits
    key |= before >> bits
    order = np.argsort(key)
    key = _numbered(key[order]) << bits
    key |= before[order] & ((np.uint64(1) << bits) - np.uint64(1))
    again = np.argsort(key)
    order = order[again]
    if stable and len(order):
        key = _numbered(key[again])
        bits = np.uint64(_bits(order))
        key <<= bits
        key |= order.astype(np.uint64)
        key.sort()
        order = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return order


def _packed(*arrays):
    """Arrays as one compressed parcel."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], dtype=np.int64).tobytes()
    kinds = "".join(a.dtype.str.ljust(4) for a in arrays).encode()
    return zstandard.ZstdCompressor(level=1).compress(head + kinds + b"".join(a.tobytes() for a in arrays))


def _unpacked(parcel):
    raw = zstandard.ZstdDecompressor().decompress(parcel)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    lengths = np.frombuffer(raw, np.int64, n, 8)
    at, arrays = 8 * (n + 1) + 4 * n, []
    for i, length in enumerate(lengths.tolist()):
        kind = np.dtype(raw[8 * (n + 1) + 4 * i : 8 * (n + 1) + 4 * i + 4].decode().strip())
        arrays.append(np.frombuffer(raw, kind, length, at))
        at += length * kind.itemsize
    return arrays


def _cut(keys, shards):
    """Where each shard begins in sorted shard numbers."""
    return np.searchsorted(keys, np.arange(shards + 1))


def count_words(docs: DataFrame, shards, ids, text) -> DataFrame:
    """Per shard of words: training tokens, different training words, all tokens, frequent words with both counts."""

    def count(batches):
        for _, out, sizes, tokens, hashes in _blocks(batches):
            trained = np.repeat(~out, sizes)
            every = np.bincount(tokens, minlength=len(hashes)).astype(np.uint32)
            known = np.bincount(tokens[trained], minlength=len(hashes)).astype(np.uint32)
            shard = hashes % np.uint64(shards)
            order = np.lexsort((hashes, shard))
            cuts = _cut(shard[order], shards)
            kept = [(s, order[a:b]) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([s for s, _ in kept], pa.int64()),
                "parcel": pa.array([_packed(hashes[i], known[i], every[i]) for _, i in kept], pa.binary()),
            })

    def add(table):
        hashes, known, every = (np.concatenate(x) for x in zip(*(_unpacked(p.as_py()) for p in table.column("parcel"))))
        words, at = np.unique(hashes, return_inverse=True)
        known, every = np.bincount(at, known).astype(np.int64), np.bincount(at, every).astype(np.int64)
        # A word is frequent by its share of all tokens; those of a shard are at most its tokens, so these suffice.
        most = np.argsort(-every, kind="stable")[: int(8 / FREQUENT)]
        return pa.table({
            "trained": pa.array([int(known.sum())], pa.int64()),
            "words": pa.array([int((known > 0).sum())], pa.int64()),
            "tokens": pa.array([int(every.sum())], pa.int64()),
            "word": pa.array([words[most].astype(np.int64).tolist()], pa.list_(pa.int64())),
            "known": pa.array([known[most].tolist()], pa.list_(pa.int64())),
            "every": pa.array([every[most].tolist()], pa.list_(pa.int64())),
        })

    parcels = docs.select(docs[ids].cast("bigint").alias("doc_id"), docs[text].alias("text")).mapInArrow(count, "shard bigint, parcel binary")
    return parcels.groupBy("shard").applyInArrow(
        add, "trained bigint, words bigint, tokens bigint, word array<bigint>, known array<bigint>, every array<bigint>"
    )


def _parcels(shards, frequent):
    """The map side of scoring: the n-grams of a block by shard, and what the block's documents are."""

    def run(batches):
        task = TaskContext.get().partitionId() << 32
        for number, (docs, out, sizes, tokens, hashes) in enumerate(_blocks(batches)):
            block = task + number
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([block % shards], pa.int64()), "block": pa.array([block], pa.int64()), "kind": pa.array([0], pa.int32()),
                "parcel": pa.array([_packed(np.array([-1 if d is None else d for d in docs], dtype=np.int64), np.array([d is None for d in docs]), out, sizes)], pa.binary()),
            })
            start = np.uint32(len(hashes))
            hashes = np.r_[hashes, np.uint64(xxhash.xxh64_intdigest(START, SEED) >> 1)]
            doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
            first = np.r_[0, np.cumsum(sizes)[:-1]]
            v = np.r_[start, tokens[:-1]]
            v[first] = start
            u = np.r_[start, v[:-1]]
            u[first] = start
            short = (hashes >> np.uint64(31)).astype(np.uint32)
            rank = np.empty(len(hashes), dtype=np.int64)
            rank[np.argsort(hashes, kind="stable")] = np.arange(len(hashes))
            shard = (hashes % np.uint64(shards)).astype(np.int64)[tokens]
            hot = np.isin(hashes, frequent)[tokens]
            shard[hot] = ((hashes[tokens[hot]] ^ (short[v[hot]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(20)) % np.uint64(shards)
            before = (short[v].astype(np.uint64) << np.uint64(32)) | short[u]
            order = _ordered(shard * len(hashes) + rank[tokens], before, stable=True)
            doc, before, w, shard = doc[order], before[order], tokens[order], shard[order]
            # Equal n-grams of a document are one entry with a count.
            new = np.r_[True, (doc[1:] != doc[:-1]) | (before[1:] != before[:-1]) | (w[1:] != w[:-1]) | (shard[1:] != shard[:-1])]
            at = np.flatnonzero(new)
            count = np.diff(np.r_[at, len(new)]).astype(np.uint32)
            doc, before, w, shard = doc[at], before[at], w[at], shard[at]
            cuts = _cut(shard, shards)
            rows = []
            for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    runs = np.flatnonzero(np.r_[True, w[a + 1 : b] != w[a : b - 1]])
                    narrow = np.uint16 if len(sizes) <= 65536 else np.uint32
                    rows.append((s, _packed(
                        hashes[w[a:b][runs]], np.diff(np.r_[runs, b - a]).astype(np.uint32), (before[a:b] >> np.uint64(32)).astype(np.uint32),
                        before[a:b].astype(np.uint32), doc[a:b].astype(narrow), count[a:b], out,
                    )))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([s for s, _ in rows], pa.int64()), "block": pa.array([block] * len(rows), pa.int64()),
                "kind": pa.array([1] * len(rows), pa.int32()), "parcel": pa.array([p for _, p in rows], pa.binary()),
            })

    return run


def build_trie(word, before, known, totals, unigram, weights):
    """The trie of sorted training n-grams (word, before: two 32-bit hashes) with counts.

    ``totals``: training counts of the different words of ``word``, in order. Each node has the logarithm of the
    numerator for an n-gram that ends here, and, but for the deepest, of the denominator when its words are a context.
    """
    a, b, m = weights
    v = before >> np.uint64(32)
    if not len(word):
        none, whole, part = np.zeros(0), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        return Trie([(whole, None, [none, none]), (whole, part, [none, none]), (whole, part, [none])])
    new1 = np.r_[True, word[1:] != word[:-1]]
    new2 = new1 | np.r_[True, v[1:] != v[:-1]]
    new3 = new2 | np.r_[True, before[1:] != before[:-1]]
    at1, at2, at3 = (np.flatnonzero(x) for x in (new1, new2, new3))
    count2 = np.add.reduceat(known, at2).astype(np.float64)
    count3 = np.add.reduceat(known, at3).astype(np.float64)
    parent2, parent3 = np.cumsum(new1)[at2] - 1, np.cumsum(new2)[at3] - 1
    floor = m * unigram(totals)
    number2 = b * count2 + floor[parent2]
    number3 = a * count3 + number2[parent3]
    context2 = a * count2 + (b * totals + m)[parent2]
    return Trie([
        (word[at1], None, [np.log10(floor), np.log10(b * totals + m)]),
        (v[at2], parent2, [np.log10(number2), np.log10(context2)]),
        (before[at3] & np.uint64(0xFFFFFFFF), parent3, [np.log10(number3)]),
    ])


def look_up(trie, word, before, unigram, weights):
    """For sorted n-grams (word, before): (log10 of the numerator, log10 of the denominator with the last two words as context)."""
    _, _, m = weights
    new = np.r_[True, word[1:] != word[:-1]][: len(word)]
    node1 = trie.find(0, word[new])[np.cumsum(new) - 1]
    pair = np.r_[True, (word[1:] != word[:-1]) | ((before[1:] ^ before[:-1]) >> np.uint64(32) > 0)] if len(word) else np.zeros(0, dtype=bool)
    group = np.cumsum(pair) - 1
    heads = np.flatnonzero(pair)
    node2 = trie.find(1, before[heads] >> np.uint64(32), node1[heads])[group]
    node3 = trie.find(2, before & np.uint64(0xFFFFFFFF), node2)
    number = np.full(len(word), np.log10(m * unigram(np.zeros(1)))[0])
    context = np.full(len(word), np.log10(m))
    for depth, node in ((0, node1), (1, node2), (2, node3)):
        known = node >= 0
        number[known] = trie.value(depth, 0, node[known])
        if depth < 2:
            context[known] = trie.value(depth, 1, node[known])
    return number, context


def _scored(totals, weights):
    """The reduce side: build the shard's trie, score all its n-grams, add up by block and document."""
    trained, different, frequent, frequent_known = totals

    def unigram(count):
        return (count + ADDED) / (trained + ADDED * (different + 1))

    end = np.uint64(xxhash.xxh64_intdigest(END, SEED) >> 1)

    def run(table):
        blocks, kinds, parcels = table.column("block").to_pylist(), table.column("kind").to_pylist(), table.column("parcel")
        rows = [(b, 0, p.as_py()) for b, k, p in zip(blocks, kinds, parcels) if k == 0]
        parts = [(b, *_unpacked(p.as_py())) for b, k, p in zip(blocks, kinds, parcels) if k == 1]
        if parts:
            before = np.concatenate([(p[3].astype(np.uint64) << np.uint64(32)) | p[4] for p in parts])
            known = np.concatenate([np.where(p[7][p[5]], 0, p[6]) for p in parts]).astype(np.int64)
            # Words by their places among those of the shard.
            words = np.unique(np.concatenate([p[1] for p in parts]))
            place = np.concatenate([np.repeat(np.searchsorted(words, p[1]).astype(np.int32), p[2]) for p in parts])
            order = _ordered(place, before)
            place, before, known = place[order], before[order], known[order]
            new = np.r_[True, (place[1:] != place[:-1]) | (before[1:] != before[:-1])]
            heads = np.flatnonzero(new)
            at, gram_before = place[heads], before[heads]
            gram_word, gram_known = words[at], np.add.reduceat(known, heads)
            # Back to the entries in the order of the parcels.
            gram = np.empty(len(order), dtype=np.int32)
            gram[order] = np.cumsum(new, dtype=np.int32) - 1
            del place, before, known, order, new, heads
            count = np.bincount(at, gram_known)
            # The n-grams of a frequent word are in several shards, its count is known from the first pass.
            if len(frequent):
                known_at = np.searchsorted(frequent, words)
                known_at[known_at == len(frequent)] = 0
                hit = frequent[known_at] == words
                count[hit] = frequent_known[known_at[hit]]
            taught = gram_known > 0
            has = np.zeros(len(words), dtype=bool)
            has[at[taught]] = True
            taught_words = np.flatnonzero(has)
            trie = build_trie(gram_word[taught], gram_before[taught], gram_known[taught], count[taught_words], unigram, weights)
            number, context = look_up(trie, gram_word, gram_before, unigram, weights)
            # A frequent word that has no training n-gram here still has its own count.
            lost = (count[at] > 0) & ~has[at]
            number[lost] = np.log10(weights[2] * unigram(count[at[lost]]))
            context[lost] = np.log10(weights[1] * count[at[lost]] + weights[2])
            gain = number - np.where(gram_word == end, 0.0, context)
            base = np.log10(count + ADDED)[at]
            seen = count[at] > 0
            start = 0
            for block, *part in parts:
                doc, times = part[4], part[5]
                own = gram[start : start + len(doc)]
                start += len(doc)
                docs = np.flatnonzero(np.bincount(doc))
                add = [np.bincount(doc, times * x[own])[docs] for x in (gain, base, seen)]
                rows.append((block, 1, _packed(docs.astype(np.uint32), add[0].astype(np.float32), add[1], add[2].astype(np.uint32))))
        return pa.table({
            "block": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([r[1] for r in rows], pa.int32()),
            "parcel": pa.array([r[2] for r in rows], pa.binary()),
        })

    return run


def _gathered(trained, different, documents, weights):
    """The rows of a block's documents from the sums of all shards."""
    a, b, m = weights
    scale = np.log10(trained + ADDED * (different + 1))
    opening = np.log10((a + b) * documents + m)

    def run(table):
        kinds, parcels = table.column("kind").to_pylist(), table.column("parcel")
        about = next(_unpacked(p.as_py()) for k, p in zip(kinds, parcels) if k == 0)
        doc_ids, missing, out, sizes = about
        score, base, known = np.full(len(sizes), -opening), np.zeros(len(sizes)), np.zeros(len(sizes), dtype=np.int64)
        for k, p in zip(kinds, parcels):
            if k == 1:
                docs, gain, own, seen = _unpacked(p.as_py())
                score[docs] += gain
                base[docs] += own
                known[docs] += seen
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64(), mask=missing), "held_out": pa.array(out), "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array(np.full(len(sizes), trained), pa.int64()),
            "base_score": pa.array(base - sizes * scale, pa.float64()), "score": pa.array(score, pa.float64()),
        })

    return run


def score(docs: DataFrame, ids="doc_id", text="text", weights=(TRIGRAM, BIGRAM, UNIGRAM)) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Null and empty texts have one token, their end. Rows with a repeated id are scored each; a null id counts as
    the empty text for the choice of training rows. Other columns do not matter; an empty table gives an empty
    table. If no row teaches, all words are unknown.
    """
    length = docs.agg(F.sum(F.length(text)), F.count("*")).first()
    shards = 1 + (length[0] or 0) // CHARACTERS_PER_SHARD
    counts = stored(count_words(docs, shards, ids, text), "words")
    # Three sums, and of the most frequent words those above a share of the tokens: at most eight for each shard.
    trained, different, tokens = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("trained", "words", "tokens")]).first()
    words = counts.select(F.explode(F.arrays_zip("word", "known", "every")).alias("w")).select("w.*")
    listed = words.where(F.col("every") > max(1, tokens * FREQUENT / shards)).orderBy("word").toPandas()
    frequent, frequent_known = listed["word"].to_numpy(dtype=np.uint64), listed["known"].to_numpy(dtype=np.int64)
    documents = docs.where(F.crc32(F.coalesce(F.col(ids).cast("bigint").cast("string"), F.lit(""))) % HELD_OUT != 0).count()
    rows = docs.select(docs[ids].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    parcels = rows.mapInArrow(_parcels(shards, frequent), "shard bigint, block bigint, kind int, parcel binary")
    sums = parcels.groupBy("shard").applyInArrow(
        _scored((trained, different, frequent, frequent_known), weights), "block bigint, kind int, parcel binary"
    )
    return sums.groupBy("block").applyInArrow(
        _gathered(trained, different, documents, weights),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
