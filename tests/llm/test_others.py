"""Operators on conversations, licences, vectors and pages, the trie's sequences, and the pipeline."""

import hashlib
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import catalog, chat, elias_fano, lattice, licences, pages
from tallyspark.llm.elias_fano import Sequence, Trie

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    assert differences(spark, connect(SF), name, catalog.QUERIES[name], catalog.SQL[name], SF) == []


def test_chat_layouts_become_the_same_turns(spark):
    records = [
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}',
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
        '{"data":{"turns":[{"speaker":"human","utterance":"q"},{"speaker":"bot","utterance":"a"}]}}',
        '{"prompt":"q","completion":"a"}', '{"response":"a","prompt":"q"}', '{"question":"q","answer":"a"}',
        '{"instruction":"q","output":"a"}', '{"system":null,"instruction":"q","output":"a"}',
    ]
    odd = ['{"other":1}', "no json", None, "[]", '{"messages":[{"role":null,"content":null}]}']
    frame = spark.createDataFrame([(i, r, "x") for i, r in enumerate(records + odd)], "conv_id long, record string, turns string")
    rows = {r.conv_id: r for r in chat.canonical_turns(frame).collect()}
    for i in range(len(records)):
        assert [tuple(t) for t in rows[i].turns] == [("user", "q"), ("assistant", "a")], records[i]
    n = len(records)
    assert all(rows[n + i].turns is None and rows[n + i].layout is None for i in range(4)) and [tuple(t) for t in rows[n + 4].turns] == [("", "")]
    formatted = {r.conv_id: r for r in chat.format_turns(chat.canonical_turns(frame)).collect()}
    assert formatted[n].formatted is None and formatted[0].formatted == "<|im_start|>user<|im_sep|>q<|im_end|><|im_start|>assistant<|im_sep|>a<|im_end|>"


def test_chat_reads_back_any_text(spark):
    texts = ["", "\\", "\\\\</s>", "</s>[INST] ok [/INST]", "<|im_end|><|im_sep|><|im_start|>", "<<SYS>>\n<</SYS>>", "é😀\x00\n\r\t", "<s><\\s>", "<|im\\_end|>", "x" * 50_000, None]
    rows = [(1, i, "assistant" if i % 2 else "us<|im_sep|>er", t, 0) for i, t in enumerate(texts)] + [(None, 0, None, "t", 0), (2, 1, "user", "b", 0), (2, 1, "user", "a", 0)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record int")
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(frame)).collect()}
    clean = [t or "" for t in texts]
    want = "".join(f"{'assistant' if i % 2 else 'us<|im_sep|>er'}\n{t}\n" for i, t in enumerate(clean))
    loss = "".join(clean[1::2])
    assert got[1].n_turns == len(texts) and got[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    probe = "</s>[INST] ok [/INST]"
    assert got[-7].loss_chars == len(probe) and got[-7].loss_sha256 == hashlib.sha256(probe.encode()).hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"user\na\nuser\nb\n").hexdigest() and got[None].n_turns == 1
    assert chat.digest(chat.format_conversations(frame.limit(0))).count() == 1


def test_licence_places(spark):
    texts = {
        1: "Released under the MIT License. Again, UNDER-THE_MIT license!", 2: "Licensed under the Apache License, Version 2.0.", 3: "CC BY-NC 4.0",
        4: "This work is licensed under the GNU General Public License, version 3.", 5: "mit und the license", 6: None, 7: "", 8: "...", 9: "cc by nc",
        10: "under the mit", 11: "éunder the mit license", 12: "the mit " * 20_000 + "license",
    }
    frame = spark.createDataFrame([*((d, t, "x") for d, t in texts.items()), (9, "cc by nc", "x"), (None, "CC BY NC", "x")], "doc_id long, text string, words string")
    rows = {r.doc_id: r for r in licences.digest(licences.scan(frame)).collect()}
    assert (rows[1].n_base, rows[1].first_word, rows[1].last_word, rows[1].base_labels) == (2, 1, 6, "mit")
    assert rows[2].base_labels == "apache-2" and rows[3].base_labels == "cc-by-nc" and rows[None].base_labels == "cc-by-nc"
    assert rows[4].n_base == 0 and rows[4].labels == "gpl" and rows[4].score > 0.9
    assert all(rows[d].n_base == 0 and rows[d].first_word is None for d in (5, 6, 7, 8, 10, 11))
    assert [rows[d].n_words for d in (6, 7, 8, 9, 12)] == [0, 0, 0, 3, 40_001] and rows[12].n_base == 0
    assert licences.scan(frame.limit(0)).count() == 0


def close_pairs(x, threshold=0.95):
    x = np.asarray(x, dtype=np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T >= threshold


def test_lattice_recall_and_groups(spark, monkeypatch):
    monkeypatch.setattr(lattice, "SLICE", 60)
    random = np.random.default_rng(2)
    base = random.standard_normal((60, 64))
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    rows = [*unit]
    for u in unit[:40]:
        for cosine in (0.951, 0.96, 0.98):
            side = random.standard_normal(64)
            side -= (side @ u) * u
            rows.append(cosine * u + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side))
    rows += [unit[50] + 0.01 * random.standard_normal(64) for _ in range(150)] + [unit[51]] * 100
    x = np.array(rows, dtype=np.float32)
    frame = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], "vec_id long, embedding array<float>, id string")
    got = {r.vec_id: r for r in lattice.near_duplicates(frame).collect()}
    near = close_pairs(x)
    want = near.sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.95 * want.sum()
    assert found[51] == want[51] == 100 and found[50] == want[50]
    assert all(got[i].kept == (got[i].component_id == i) for i in got) and got[len(x) - 1].component_id == 51


def test_lattice_probing_finds_pairs_of_a_larger_index():
    random = np.random.default_rng(9)
    u = random.standard_normal((3000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    side = random.standard_normal(u.shape)
    side -= (side * u).sum(axis=1, keepdims=True) * u
    v = 0.95 * u + np.sqrt(1 - 0.95**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    for count in (10_000, 10**6, 10**9):
        found = lattice.Lattice.for_size(count, 64)
        own, probed = lattice.codes(u, found)
        other, other_probed = lattice.codes(v, found)
        assert (lattice.first_meeting(own, probed, other, other_probed) != 0).mean() > 0.93


def test_vectors_of_many_lengths_all_find_their_twins(spark):
    random = np.random.default_rng(9)
    rows = []
    for length in range(1, 1010):
        v = random.normal(size=length)
        rows += [(2 * length, v.tolist()), (2 * length + 1, (v * 3 + 1e-3 * random.normal(size=length) * (length > 1)).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = lattice.near_duplicates(frame).collect()
    assert len(found) == 2018 and all(r.n_links == 1 and r.component_id == r.vec_id // 2 * 2 for r in found)


def test_lattice_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [1.0, 1e-3]), (8, [2.0, 2e-3]), (8, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e300, 1e297])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, weight int")
    got = lattice.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    assert sorted((r.n_links, r.component_id) for r in got if r.vec_id in (7, 8, 10)) == [(3, 7)] * 4
    assert all(r.n_links == 0 and r.component_id == r.vec_id for r in got if r.vec_id not in (7, 8, 10))
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


def test_e8_points_are_nearest():
    random = np.random.default_rng(4)
    x = random.standard_normal((200, 8)) * 2
    point = lattice.nearest_e8(x)
    short = lattice.roots()
    assert len(short) == 240 and np.allclose((short**2).sum(axis=1), 2)
    own = ((x - point) ** 2).sum(axis=1)
    assert all((((x - point)[:, None] - short[None]) ** 2).sum(-1).min(axis=1) >= own - 1e-9)
    doubled = np.rint(2 * point)
    assert np.allclose(doubled, 2 * point) and ((doubled.sum(axis=1) % 4) == 0).all()


PAGE = """<html><head><title>T</title><style>x</style></head><body><header><a href=/>Home</a> Site</header>
<div id="menu"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class="content"><h1>The story</h1><div class="notice">We use cookies</div>
<p>First paragraph of the story &amp; it goes on with&nbsp;some
 more words.</p><p>Yes.</p><div class="ad-slot">Buy now!</div><script>var t="</p>";</script><p>Second one, x<b>y</b>z is here and it is long enough to count.</p>
<form>Name <input name=q><button>Go</button></form><div class="comments"><p>Great post! I liked it a lot and I will come back to read more.</p></div></div>
<aside>Sidebar text with many words in it to look like an article text, really.</aside><footer>(c) 2020</footer></body></html>"""


def test_page_text(spark):
    frame = spark.createDataFrame([(1, "u", PAGE, 0), (2, None, None, 0), (3, "u", "", 0), (None, "u", "<article><p>a &lt;p&gt; <p>b<", 0), (1, "u", PAGE, 0)], "page_id long, url string, html string, text int")
    rows = pages.extract(frame).collect()
    found = {r.page_id: r for r in rows}
    assert len(rows) == 5 and found[2].text == found[3].text == "" and found[2].n_chars == 0
    assert found[1].text == "The story First paragraph of the story & it goes on with some more words. Yes. Second one, xyz is here and it is long enough to count."
    assert found[None].text == "a <p> b<" and found[1].n_chars == len(found[1].text)
    assert pages.extract(frame.limit(0)).count() == 0


def test_given_pages_lose_nothing_of_the_article(spark):
    rows = catalog.QUERIES["op10_html"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in rows:
        start = r.html.index("<article>")
        article = r.html[start : r.html.find("</article>", start) if "</article>" in r.html else len(r.html)]
        want = " ".join(text for text, _ in pages.main_blocks(article))
        assert r.text == want


def test_minimum_cut_against_all_labellings():
    random = np.random.default_rng(6)
    for _ in range(100):
        n = int(random.integers(1, 8))
        costs = [int(c) for c in random.integers(-50, 50, n)]
        tied = [(i, j, int(random.integers(0, 40))) for i in range(n) for j in range(i + 1, n) if random.random() < 0.5]

        def energy(side):
            return sum(c if c > 0 and not s else -c if c < 0 and s else 0 for c, s in zip(costs, side)) + sum(c for i, j, c in tied if side[i] != side[j])

        best = min(energy([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert energy(pages.content_side(costs, tied)) == best


@pytest.mark.parametrize(("n", "top"), [(0, 10), (1, 0), (5, 0), (1000, 50), (1000, 10**6), (3000, 1 << 52)])
def test_sequences_find_successors(n, top):
    random = np.random.default_rng(n)
    values = np.sort(random.integers(0, top + 1, n).astype(np.uint64))
    sequence = Sequence(*Sequence.build(values))
    assert (sequence.get(np.arange(n)) == values).all()
    asked = np.r_[random.integers(0, top + 5, 500).astype(np.uint64), values, np.uint64(0), np.uint64(top)]
    assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()


def test_search_among_numbers_of_equal_high_bits_is_by_halves(monkeypatch):
    calls, unpack = [], elias_fano._unpack
    monkeypatch.setattr(elias_fano, "_unpack", lambda *args: calls.append(1) or unpack(*args))
    values = np.r_[np.arange(0, 20_000, 2), 1 << 50].astype(np.uint64)
    sequence = Sequence(*Sequence.build(values))
    asked = np.arange(20_010).astype(np.uint64)
    assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()
    assert len(calls) < 30
    assert (sequence.find(asked) == np.where((asked % 2 == 0) & (asked < 20_000), asked // 2, -1).astype(np.int64)).all()
    assert sequence.find(np.array([1 << 50, (1 << 50) + 1], dtype=np.uint64)).tolist() == [10_000, -1]


def test_trie_is_compact_and_finds_children_of_their_context():
    random = np.random.default_rng(8)
    first = np.unique(random.integers(0, 1 << 62, 500).astype(np.uint64))
    second = np.unique(np.stack([random.integers(0, len(first), 5000), random.integers(0, 60, 5000)], axis=1), axis=0)
    values = random.random(len(second))
    trie = Trie([(first, None, [random.random(len(first))]), (second[:, 1].astype(np.uint64), second[:, 0], [values])])
    asked = np.stack([random.integers(0, len(first), 3000), random.integers(0, 70, 3000)], axis=1)
    node = trie.find(1, asked[:, 1].astype(np.uint64), trie.find(0, first[asked[:, 0]]))
    place = {tuple(x): i for i, x in enumerate(second.tolist())}
    assert node.tolist() == [place.get(tuple(x), -1) for x in asked.tolist()]
    hit = node >= 0
    assert np.abs(trie.value(1, 0, node[hit]) - values[node[hit]]).max() < 1e-4
    assert trie.find(1, np.array([1], dtype=np.uint64), np.array([-1]))[0] == -1


def test_pipeline_stages_agree_with_the_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns and docs.count() <= before, name
        before = docs.count()
    assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    key = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, last.select(key).collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).select(key).collect()))


# --- Pages: what must not be lost ---------------------------------------------


def paragraphs():
    return [f"Paragraph {i} has a fairly long text that goes on for a while, so that nobody could take it for a menu or such." for i in range(6)]


def kept_of(page):
    return [text for text, keep in pages.main_blocks(page) if keep]


@pytest.mark.parametrize("tag", ["svg", "select", "math", "object", "datalist", "template"])
def test_unclosed_elements_take_no_text_away(tag):
    body = "".join(f"<p>{p}</p>" for p in paragraphs())
    assert kept_of(f"<article><p>{paragraphs()[0]}</p><{tag}>{body}</article>")[1:] == paragraphs()
    assert kept_of(f"<article><{tag}>{body}<{tag}></{tag}></article>") == paragraphs()
    hidden = kept_of(f"<article>{body}<{tag}><i>hidden words</i></{tag}></article>")
    assert hidden[:6] == paragraphs() and (tag == "math") == any("hidden" in t for t in hidden)


@pytest.mark.parametrize("name", ["social-science", "toc-article post", "legal news-story", "post tags-politics"])
def test_class_names_with_other_words_are_no_boilerplate(name):
    body = "".join(f"<p>{p}</p>" for p in paragraphs())
    assert kept_of(f'<html><body><div class="{name}">{body}</div></body></html>') == paragraphs()


@pytest.mark.parametrize("name", ["sidebar", "social-share", "footer-links", "nav menu", "cookie-banner", "ad", "comments post", "promo-box-2"])
def test_page_furniture_goes(name):
    body = "".join(f"<p>{p}</p>" for p in paragraphs())
    page = f'<html><body><article>{body}</article><div class="{name}"><p>{paragraphs()[0]}</p></div></body></html>'
    assert kept_of(page) == paragraphs()


def test_captions_and_formulas_stay():
    page = (
        f"<article><p>{paragraphs()[0]}</p><p>The sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> is large and this is long enough to be read.</p>"
        f"<figure><img src=a><figcaption>A caption of a figure that belongs to the article.</figcaption></figure><p>{paragraphs()[1]}</p></article>"
    )
    assert kept_of(page)[1:3] == ["The sum x+1 is large and this is long enough to be read.", "A caption of a figure that belongs to the article."]


def test_unclosed_inline_tags_cost_no_more_than_their_number():
    start = time.process_time()
    assert kept_of("<article><p>" + "<b>word " * 40_000) == [" ".join(["word"] * 40_000)]
    assert time.process_time() - start < 2


class Plain(HTMLParser):
    """Another reading of a page: the text of its blocks inside article elements, by the library's own parser."""

    def __init__(self):
        super().__init__()
        self.open, self.blocks, self.parts = [], [], []

    def close_block(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in pages.VOID:
            self.parts.append(" " if tag == "br" else "")
        elif tag not in pages.INLINE:
            self.close_block()
            self.open.append((tag, dict(attrs)))

    def handle_endtag(self, tag):
        if tag not in pages.INLINE and any(t == tag for t, _ in self.open):
            self.close_block()
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        tags = {t for t, _ in self.open}
        if "article" in tags and not tags & {"script", "style", "nav", "aside", "footer", "form", "header"}:
            self.parts.append(data)


def test_articles_of_given_pages_against_another_parser(spark):
    """Every block of an article element that another parser finds is in the text, unless its class says that it is not of it."""
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r.page_id: r.text for r in pages.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    seen = missed = 0
    for r in rows:
        reader = Plain()
        reader.feed(r.html or "")
        reader.close()
        long = [b for b in reader.blocks if len(b) > 150]
        seen += len(long)
        missed += sum(b not in found[r.page_id] for b in long)
    assert seen > 50 and missed <= 0.02 * seen
