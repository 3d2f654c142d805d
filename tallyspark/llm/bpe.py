"""BPE encoding and decoding, with the merges found by a segment tree over adjacent pair ranks.

The vocabulary file describes a word-level BPE: special strings are cut out of the raw
text, the rest is normalised (NFC, one space for white space, lower case), split into
words, spelt in byte letters, and merged word by word. Documents are independent, so
the whole operator is one pass over the table without a shuffle.
"""

import json
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyspark.llm.texts import slices

# Strings between spaces, and words in them, that a worker remembers. Only speed depends on it.
REMEMBERED = 400_000
# Documents that are encoded before their results leave the worker.
ROWS_AT_ONCE = 500

# Capitals that are newer than Python's own tables, with their small letters.
LATE_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
    0xA7DC: 0x019B, **{c: c + 32 for c in range(0x10D50, 0x10D66)}, **{c: c + 27 for c in range(0x16EA0, 0x16EB9)},
}
# End of fixed values.

SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, decoded string"


def byte_letters():
    """The printable letter of each byte value: itself where printable, else the next from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, spare = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


def merge(symbols, ranks):
    """Merge a list of ids until no adjacent pair has a rank; ``ranks``: (id, id) -> (rank, new id).

    The leaves of the tree hold rank and place of each pair with its right neighbour, so
    the root is the leftmost pair of the lowest rank. A merge changes three leaves.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    none = (len(ranks) + 1) * n
    rank = ranks.get
    tree = [none] * (2 * size)
    at, left = size, symbols[0]
    for right in symbols[1:]:
        found = rank((left, right))
        if found:
            tree[at] = found[0] * n + at - size
        at += 1
        left = right
    for i in range(size - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (root := tree[1]) != none:
        i = root % n
        j = after[i]
        new = symbols[i] = rank((symbols[i], symbols[j]))[1]
        symbols[j] = None
        k = after[i] = after[j]
        # The pair at i is another one now, that at j is gone, and so is what stood before i.
        value = none
        if k < n:
            before[k] = i
            found = rank((new, symbols[k]))
            if found:
                value = found[0] * n + i
            if tree[size + j] != none:
                _set(tree, size + j, none)
        _set(tree, size + i, value)
        h = before[i]
        if h >= 0:
            found = rank((symbols[h], new))
            value = found[0] * n + h if found else none
            if tree[size + h] != value:
                _set(tree, size + h, value)
    return [s for s in symbols if s is not None]


def _set(tree, at, value):
    """A new value at a leaf, and the least of two upwards as far as it changes."""
    tree[at] = value
    while at > 1:
        other = tree[at ^ 1]
        if other < value:
            value = other
        at >>= 1
        if tree[at] == value:
            return
        tree[at] = value


class Tokenizer:
    """Encoder and decoder of one vocabulary file; it remembers about ``remembered`` strings."""

    def __init__(self, path, remembered=REMEMBERED):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.ranks = {}
        for rank, entry in enumerate(model["merges"]):
            left, right = entry if isinstance(entry, list) else entry.split(" ")
            self.ranks[vocab[left], vocab[right]] = (rank, vocab[left + right])
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + self.suffix] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.split = regex.compile(_pattern(spec["pre_tokenizer"]))
        self.known = Remembered(self.chunk, remembered)

    def word(self, word):
        """The ids of one word."""
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        return merge(ids, self.ranks)

    def chunk(self, chunk):
        """(packed ids, decoded text) of a string between spaces; the words in a longer one are remembered themselves."""
        words = self.split.findall(chunk)
        if len(words) == 1 and words[0] == chunk:
            ids = self.word(chunk)
            return packed(ids), " ".join(map(self.tokens.__getitem__, ids))
        if len(words) == 1:
            return self.known[words[0]]
        parts = [self.known[w] for w in words]
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])

    def encode(self, text):
        """(ids of a whole text as little-endian unsigned 32-bit integers, decoded text); no word crosses a space.

        Without a decoder in the file, the decoded text is the tokens joined by one space.
        """
        found = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                found.append((packed([self.special[part]]), part))
            else:
                found += map(self.known.__getitem__, normalise(part).replace("\n", " ").split(" "))
        # Strings without a word have no ids and no text.
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[0]])

    def decode(self, ids):
        """The text of packed ids."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Remembered(dict):
    """Results by string, of two generations: what was not asked for since the last one began is forgotten.

    Both together hold about ``size`` strings; strings of the size of a text are not kept.
    """

    def __init__(self, make, size):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        made = self.old.pop(key, None)
        if made is None:
            made = self.make(key)
            if len(key) > 64:
                return made
        if len(self) >= self.size // 2:
            self.old = dict(self)
            self.clear()
        self[key] = made
        return made


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def normalise(text):
    """NFC and lower case, letter by letter (so no final sigma). Latin-1 text is in NFC already."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").translate(LATE_CAPITALS)
    return text.lower()


def _pattern(pre_tokenizer):
    for step in pre_tokenizer.get("pretokenizers", [pre_tokenizer]):
        if step["type"] == "Split":
            return step["pattern"]["Regex"]
    raise ValueError("the vocabulary file has no split pattern")


_LOADED = {}


def loaded(path, remembered=REMEMBERED):
    """The tokenizer of a file, once per worker."""
    if (path, remembered) not in _LOADED:
        _LOADED[path, remembered] = Tokenizer(path, remembered)
    return _LOADED[path, remembered]


def encode_documents(docs: DataFrame, path, text="text", ids="doc_id", remembered=REMEMBERED) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded text, for every row of ``docs``.

    Null text counts as empty: no ids and an empty decoded text. Repeated ids give
    repeated rows, a null id stays null; other columns of ``docs`` do not matter, and an
    empty table gives an empty table. ``path`` must exist on every executor. A worker remembers about
    ``remembered`` strings (some 300 bytes each); the result does not depend on it.
    """

    def run(batches):
        tokenizer = loaded(path, remembered)
        for batch in slices(batches, ROWS_AT_ONCE):
            made = [tokenizer.encode(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(m[0]) // 4 for m in made], pa.int64()), pa.array([m[0] for m in made], pa.binary()),
                    pa.array([m[1] for m in made], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select(docs[ids].cast("bigint"), docs[text]).mapInArrow(run, SCHEMA)


def digest(encoded: DataFrame) -> DataFrame:
    """The columns of the registered query, from the operator's ids and texts."""
    return encoded.selectExpr(
        "doc_id", "n_tokens", "sha2(ids, 256) as ids_sha256", "sha2(encode(decoded, 'UTF-8'), 256) as decoded_sha256"
    )
