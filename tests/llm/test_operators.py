"""The text operators against brute force, on the small tables and on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SMALL
from odd_rows import documents, none, odd  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casewright.llm import (
    decontamination,
    html_text,
    licenses,
    packing,
    pii,
    repetition,
    sharding,
    simhash,
    substring,
    token_files,
)
from casewright.llm.components import components
from casewright.llm.fm_index import FMIndex
from casewright.llm.queries import QUERIES
from casewright.llm.rans import Coder, table_of
from casewright.llm.tokens import Encoder, tokenizer_path
from casewright.session import shared_folder


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def words(text):
    return (text or "").encode().split()


# --- 1: substrings ---------------------------------------------------------------


def without_repeats(texts, window):
    count = Counter()
    for _, t in texts:
        w = words(t)
        count.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc, t in texts:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((doc, len(w), len(gone), kept))
    return Counter(out)


@pytest.mark.parametrize("hot", [0, 2000])
def test_substring_removal(documents, odd, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_PASSAGES", hot)
    for df in (documents, odd):
        got = substring.remove_repeats(df).select("doc_id", "n_words", "n_removed", "kept").collect()
        assert Counter(map(tuple, got)) == without_repeats(texts_of(df), substring.WINDOW)


def test_substring_removal_of_nothing(none):
    assert substring.remove_repeats(none).count() == 0


def test_fm_index_counts_patterns():
    rng = np.random.default_rng(3)
    parts = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(40)]
    weights = rng.integers(1, 3, len(parts))
    text = np.concatenate([np.append(p, 0) for p in parts])
    index = FMIndex(text, np.repeat(weights, [len(p) + 1 for p in parts]), 32)
    for least in (1, 2, 5):
        ends = np.flatnonzero(text > 0) + 1
        begins = np.concatenate([[0], np.flatnonzero(text == 0) + 1])
        lefts = np.maximum(begins[np.searchsorted(begins, ends, side="right") - 1], ends - 12)
        for end, left, got in zip(ends, lefts, index.reach(text, ends, lefts, least)):
            want = end
            while want > left and occurrences(parts, weights, text[want - 1 : end]) >= least:
                want -= 1
            assert got == want


def occurrences(parts, weights, pattern):
    n = len(pattern)
    return sum(
        w * sum((p[i : i + n] == pattern).all() for i in range(len(p) - n + 1)) for p, w in zip(parts, weights)
    )


# --- 2: personal data --------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


TRICKY = [
    "a@b.c@d.e @d.e@f.g a@@b.c x..@-.- +a@b.co.",
    "1.2.3.4.5 999.1.2.3.4 001.02.3.4 1..2.3.4 256.1.1.1 1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111--1111 41111111111111110000",
    "+1 (743) 555-3824 +12 + +1+1234567890 +1.2.3.4.5.6.7.8.9.0 ",
    "é 1.2.3.4 ü a@b.co 😀 +49 30 1234567",
]


def test_base_spans(documents):
    model = pii.train(documents)
    for text in [*(t for _, t in texts_of(documents)), *TRICKY]:
        got = [(s["kind"], s["start"], s["end"]) for s in pii.decide(text, model) if s["base"]]
        assert got == base_spans(text)


def test_model_separates_planted_candidates():
    good, bad = (1, 1, 0, 1, 1), (-1, -1, 0, -1, 1)
    model = pii.fit([(2, good, 2, 300), (2, bad, 2, 700), (4, (1, 1, 1, 1, 1), 1, 50), (4, (1, -1, -1, -1, 1), 1, 50)])
    assert model.accept(2, good, 2) and not model.accept(2, bad, 2)
    assert model.accept(4, (1, 1, 1, 1, 1), 1) and not model.accept(4, (1, -1, -1, -1, 1), 1)


def test_added_spans_and_masks(spark, odd, none):
    rows = [
        (1, "mail x@y.org or joe (at) mail (dot) com, password=a8f2c93be01d77 and (743) 555-3824"),
        (2, "nothing here"),
        (3, None),
    ]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in pii.find_private(df).collect()}
    assert found == {
        1: [("email", True), ("email", False), ("secret", False), ("phone", False)], 2: [], 3: []
    }
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[1] == "mail <EMAIL> or <EMAIL>, password=<SECRET> and <PHONE>"
    assert masked[2] == "nothing here" and masked[3] is None
    assert pii.mask(odd).count() == odd.count() and pii.find_private(none).count() == 0
    assert pii.mask(odd).columns == odd.columns


def test_long_secrets_and_local_parts_are_whole(spark):
    secret = "".join("ab7Kx9_-.Q"[k * k % 10] for k in range(3000))
    rows = [(k, f"token={secret} end of secret") for k in range(20)]
    df = spark.createDataFrame([*rows, (99, f"write to {'joe.x' * 60} (at) mail (dot) com now")], "doc_id long, text string")
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[0] == "token=<SECRET> end of secret"
    assert masked[99] == "write to <EMAIL> now"


def test_covers_take_what_touches_nothing():
    rng = np.random.default_rng(6)
    for _ in range(200):
        spans = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 80, 30), rng.integers(1, 9, 30))]
        cover, taken = pii.Cover(spans[:8]), list(spans[:8])
        for start, end in spans[8:]:
            free = all(end <= a or start >= b for a, b in taken)
            assert cover.add(start, end) == free
            if free:
                taken.append((start, end))


def test_masks_join_overlapping_spans():
    spans = [{"kind": "ip", "start": 2, "end": 6}, {"kind": "card", "start": 4, "end": 9}]
    assert pii.masked("0123456789", spans) == "01<IP>9"


# --- 3: pages ------------------------------------------------------------------------


def test_articles(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    import html

    got = {r.page_id: r.text for r in QUERIES["op3_html_text"](spark, SMALL).collect()}
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        assert got[p.page_id] == "\n".join(x for x in lines if x)


def test_other_layouts():
    long = "word " * 60
    page = (
        "<html><head><title>t</title></head><body><header>Site</header><div id='cookie-notice'>We use cookies</div>"
        f"<ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul><main><h1>Title</h1><p>{long}&amp;&nbsp;more"
        f"<p>short<ul><li>one<li><a href=x>link</a></ul><section class='comments'><p>first! {long}</section></main>"
        "<aside>side</aside><form>Name <input></form><footer>(c)</footer>"
    )
    assert html_text.main_text(page) == f"Title\n{long}& more\nshort\none"
    page = f"<main><p class=notice>Beware<p>{long}<ul><li class=ad>Buy<li>kept</ul><p>end</main>"
    assert html_text.main_text(page) == f"{long.strip()}\nkept\nend"
    assert [html_text.main_text(h) for h in (None, "", "plain", "<p>a<p>b", "<<&#x;")] == ["", "", "plain", "a\nb", "<<&#x;"]


def test_names_of_wrappers_drop_no_article():
    long = "word " * 60
    for wrapper in ("has-sidebar", "no-sidebar", "content with-menu", "layout-sidebar", "pageMenu", "sidebar"):
        page = f"<body><div class='{wrapper}'><article class='post has-comments'><h1>T</h1><p>{long}</article></div>"
        assert html_text.main_text(page) == f"T\n{long.strip()}", wrapper
    for section in ("id='social-policy'", "class='related-work'", "class='no-ads'"):
        page = f"<main><p>{long}<section {section}><p>{long}more</section></main>"
        assert html_text.main_text(page) == f"{long.strip()}\n{long}more", section
    page = f"<body><div class='layout-sidebar'><p>{long}</div><div class='sidebar'><p>side</div>"
    assert html_text.main_text(page) == long.strip()
    for name in ("comments", "comment-list", "relatedPosts", "share-buttons", "main-menu", "google-ad"):
        page = f"<body><article><p>{long}</article><div class={name}><article class=comment><p>{long}</article></div>"
        assert html_text.main_text(page) == long.strip(), name


def test_links_inside_the_main_text_stay():
    long = "word " * 60
    inner = f"<h1><a href=t>Title</a></h1><p>{long}<p><a href=x>A linked paragraph</a>.<ul><li><a href=y>link</a> one</ul>"
    want = f"Title\n{long.strip()}\nA linked paragraph.\nlink one"
    for root in ("article", "main"):
        assert html_text.main_text(f"<body><{root}>{inner}</{root}>") == want
    assert html_text.main_text(f"<article><p>{long}<ul><li><a href=y>link</a></ul></article>") == f"{long.strip()}\nlink"
    for anchor in ("<a name='top'>", "<a href='x'>", "<a name=a><a name=b>"):
        assert html_text.main_text(f"<body>{anchor}<p>{long}<p>{long}end") == f"{long.strip()}\n{long}end", anchor
    menu = "<div><a href=1>Home</a></div><div><a href=2>News</a></div><div><a href=3>More</a></div>"
    assert html_text.main_text(f"<body>{menu}<p>{long}<p><a href=z>single</a><p>{long}") == "\n".join(
        [long.strip(), "single", long.strip()]
    )


def test_nothing_of_the_article_is_lost():
    """Short sections, headings above them, several articles, and tags that never end."""
    text = "word " * 60
    long = text.strip()
    for page, want in (
        (f"<section>A, {text}</section><section>B, Short B.</section>", f"A, {long}\nB, Short B."),
        (f"<div><p>{text}</div><div><p>short two</div>", f"{long}\nshort two"),
        (f"<main><article><p>{text}</article><article><p>Short one.</article></main>", f"{long}\nShort one."),
        (f"<div class=x><h1>T</h1><section><p>{text}</section><section><p>tiny</section></div>"
         "<div class=y>Copyright</div>", f"T\n{long}\ntiny"),
        (f"<body><nav><a href=1>x</a><article><h1>T</h1><p>{text}</article>", f"T\n{long}"),
        (f"<body><nav><a href=1>x</a></nav><article><h1>T</h1><p>{text}</article>", f"T\n{long}"),
        (f"<article><div class='commentary'><p>{text}</div></article>", long),
        (f"<article><p>{text}</article><!-- broken <p>tail", long),
    ):
        assert html_text.main_text(page) == want


def test_comments_and_adverts_by_other_names():
    text = "word " * 60
    long = text.strip()
    for page in (
        f"<article><p>{text}<ol class='commentlist'><li>first {text}</ol></article>",
        f"<body><article><p>{text}</article><div id='commentlist'><p>{text}</div>",
        f"<body><div><p>{text}</div><section class='reader-feedback'><p>I say no</section>",
        f"<article><div class='advertisement-label'>Advertisement</div><p>{text}</article>",
        f"<article><div class='sidebarleft'>Left</div><p>{text}</article>",
    ):
        assert html_text.main_text(page) == long, page


def test_deep_pages_take_linear_time():
    import time

    n = 60_000
    began = time.process_time()
    for page in ("<div>" * n + "x" + "</div>" * n, "<div class=ad>" * n + "x" + "</b></p>" * n,
                 "<article class=comments>" * n + "x", "<div>x" * n):
        html_text.main_text(page)
    assert time.process_time() - began < 60


def test_pages_without_rows(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None)], "page_id long, url string, html string")
    assert [tuple(r) for r in html_text.extract(df).collect()] == [(1, None, "", 0)] * 2
    assert html_text.extract(df.where("page_id > 1")).count() == 0


# --- 4 and 6: ids ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(tokenizer_path())

    def encode(text):
        return np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()

    return encode


def test_cut_texts_have_the_ids_of_whole_ones(documents, odd, ids):
    texts = [t for _, t in texts_of(documents) + texts_of(odd)]
    texts += ["a  b", "a \n b", "x.\n\ny", "é. è, 1.2", "a\x85 b \x1c c", "it's. we'll!", "日本 語", "x'.s 't", " ", "\n"]
    encoder = Encoder(tokenizer_path())
    assert encoder.encode(pa.array(texts)) == [ids(t) for t in texts]
    assert encoder.encode(pa.array(texts)) == [ids(t) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 63, 65, 1000, 70_000, 300_001])
def test_rans_round_trip(n):
    values = np.minimum(np.random.default_rng(n).zipf(1.3, n), 50_000).astype(np.uint32)
    coder = Coder(table_of(values))
    block = coder.encode(values)
    assert (coder.decode(block, coder.slots()) == values).all()
    broken = block._replace(crc=block.crc ^ 1)
    with pytest.raises(ValueError, match="checksum"):
        coder.decode(broken, coder.slots())


def test_token_files(spark, documents, odd, none, ids, monkeypatch):
    for df in (documents, odd):
        folder = shared_folder(spark, "token-test")
        token_files.write_tokens(df, folder)
        got = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
        want = sorted(((i, ids(t)) for i, t in texts_of(df)), key=lambda x: (x[0] is not None, x[0] or 0))
        assert [r.doc_id for r in got] == [i for i, _ in want]
        at = 0
        for r in got:
            assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
            at += r.n_tokens
        assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter(want)
    folder = shared_folder(spark, "token-test")
    token_files.write_tokens(none, folder)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_packing(documents, odd, none, ids):
    for df in (documents, odd):
        pieces = packing.pack(df).collect()
        filled = {}
        for p in pieces:
            filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert sorted(filled) == list(range(len(filled)))
        for k, parts in filled.items():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at and length > 0
                at += length
            assert at == 1024 or k == len(filled) - 1
        of_doc = {}
        for i, t in texts_of(df):
            of_doc.setdefault(i, []).append(ids(t))
        got, want = Counter(), Counter()
        for p in pieces:
            got[p.doc_id] += p.length
            options = {zlib.crc32(x[4 * p.start : 4 * (p.start + p.length)]) for x in of_doc[p.doc_id]}
            assert p.ids_crc32 in options
        for i, x in of_doc.items():
            want[i] = sum(len(v) // 4 for v in x)
        assert got == want
    assert packing.pack(none).count() == 0


# --- 5: test items ------------------------------------------------------------------------


def score(a, b):
    """Smith-Waterman score of two lists of words."""
    last, best = [0] * (len(b) + 1), 0
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, now[j] - 1))
        best, last = max(best, *now), now
    return best


def test_alignment():
    rng = np.random.default_rng(5)
    a = rng.integers(1, 6, (30, 9)).astype(np.uint64)
    b = rng.integers(1, 6, (30, 17)).astype(np.uint64)
    a[::3, 6:] = 0
    b[::2, 12:] = 0
    got, end = decontamination.align(a, b)
    for x, y, s, e in zip(a, b, got, end):
        x, y = x[x > 0].tolist(), y[y > 0].tolist()
        assert s == score(x, y) == score(x, y[:e])


def test_contamination(spark, documents, odd, none):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    edited = items[0].split()
    edited[5] = "changed"
    del edited[12]
    extra = [(1001, "before " * 30 + " ".join(edited) + " after" * 30), (1002, "x y z"), (1003, None)]
    df = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated_passages(df, benchmark).collect()}
    want = {
        (i, k) for i, t in texts_of(df) for k, x in items.items() if t and " ".join(x.split()) in " ".join(t.split())
    }
    assert want <= set(got) and (1001, 0) in got
    n = len(items[0].split())
    assert got[1001, 0].score >= 0.8 and abs(got[1001, 0].start - 30) <= 1 and abs(got[1001, 0].end - 30 - n) <= 2
    assert not {i for i, _ in got} & {1002, 1003}
    for (i, k), r in got.items():
        a, b = (re.sub("[^a-z0-9\x80-\U0010ffff]", " ", x.lower()).split() for x in (items[k], dict(texts_of(df))[i]))
        if not re.search("[^\x00-\x7f]", items[k] + dict(texts_of(df))[i]):
            assert r.score == pytest.approx(score(a, b) / (2 * len(a)))
    kept = {r.doc_id for r in decontamination.clean_documents(df, benchmark).collect()}
    assert kept == {i for i, _ in texts_of(df)} - {i for i, _ in got}
    assert decontamination.contaminated_passages(none, benchmark).count() == 0
    assert decontamination.contaminated_passages(documents, benchmark.where("item_id < 0")).count() == 0
    assert decontamination.clean_documents(odd, benchmark).count() == odd.count()


def edits(words, rng):
    """Edited copies: every n-th word or one by chance changed, left out or followed by a new one."""
    n = len(words)
    for step in (2, 3, 4, 5, 10):
        yield f"changed/{step}", [f"n{i}" if i % step == step - 1 else w for i, w in enumerate(words)]
        yield f"left out/{step}", [w for i, w in enumerate(words) if i % step != step - 1]
        yield f"put in/{step}", [x for i, w in enumerate(words) for x in ([w, f"n{i}"] if i % step == step - 1 else [w])]
    for share in (0.1, 0.2, 0.3, 0.4):
        at = rng.random(n) < share
        yield f"changed {share}", [f"n{i}" if x else w for i, (w, x) in enumerate(zip(words, at))]
        yield f"left out {share}", [w for w, x in zip(words, at) if not x]
        yield f"put in {share}", [x for i, (w, y) in enumerate(zip(words, at)) for x in ([w, f"n{i}"] if y else [w])]


def test_edited_copies_are_found(spark, documents):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    rng = np.random.default_rng(7)
    extra, want = [], {}
    for r in benchmark.collect():
        # Lower case holds for ASCII letters only.
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        a = re.sub("[^a-z0-9\x80-\U0010ffff]", " ", lower).split()
        for kind, b in edits(a, rng):
            doc = 10_000 + len(extra)
            extra.append((doc, " ".join(["before"] * 9 + b + ["after"] * 9)))
            if score(a, b) >= len(a):
                want.setdefault(kind, set()).add((doc, r.item_id))
    df = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated_passages(df, benchmark).collect()}
    assert {"changed/3", "left out/3", "put in/2", "changed 0.3"} <= set(want)
    missed = {kind: len(pairs - got) / len(pairs) for kind, pairs in want.items() if pairs - got}
    assert all(share <= 0.1 for share in missed.values()), missed
    # No passage is reported without the score.
    assert not {i for i, _ in got if i >= 10_000} - {10_000 + k for k in range(len(extra))}


def test_seeds_are_rare_and_present(spark, documents):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = next(decontamination.item_blocks(benchmark))
    frequency, n = decontamination.document_frequencies(documents, items)
    assert n == documents.count()
    seeds = decontamination.chosen_seeds(items, frequency, n)
    assert (frequency[seeds] > 0).all()
    for k in range(len(items.ids)):
        mine = items.item == k
        chosen = np.isin(np.flatnonzero(mine), seeds)
        left = frequency[mine][~chosen & (frequency[mine] > 0)]
        if len(left):
            assert chosen.sum() >= decontamination.LEAST_SEEDS and left.min() >= frequency[mine][chosen].max()


def test_items_in_blocks_give_the_same(spark, documents):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = list(decontamination.item_blocks(benchmark))
    parts = list(decontamination.item_blocks(benchmark, limit=1000))
    assert len(whole) == 1 and len(parts) > 3
    assert sorted(i for b in parts for i in b.ids.tolist()) == sorted(whole[0].ids.tolist())


# --- 7: near-duplicates ---------------------------------------------------------------------


def fingerprint(text):
    w = [x.lower() for x in words(text)]
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def reachable(prints, distance=4):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(v) for v in prints]


def test_golay_keys_meet():
    _, _, count = simhash.golay()
    assert Counter(count.tolist()) == {1: 277, 6: 1771}
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 2000, np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, 4, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    keys = [{} for _ in range(2)]
    for k, v in enumerate((x, y)):
        for row, key in zip(*map(np.ndarray.tolist, simhash.composite_keys(v))):
            keys[k].setdefault(row, set()).add(key)
    assert all(keys[0][i] & keys[1][i] for i in range(len(x)))


@pytest.mark.parametrize("small", [1, 32])
def test_buckets_lose_no_link(monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**64, 8, np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (600, 3)).astype(np.uint64)
    prints = rng.choice(centre, 600) ^ np.bitwise_xor.reduce(flips, axis=1)
    a, b = simhash.bucket_links(np.zeros(600, np.int32), prints, 4)
    root = dict(zip(*map(np.ndarray.tolist, simhash.forest(a, b))))
    got = [root.get(v, v) for v in prints.tolist()]
    assert got == reachable(prints.tolist())


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 7), (200, 300), (300, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 51)}, 100: 0, 300: 200}


def test_near_duplicates(documents, odd, none):
    for df in (documents, odd):
        rows = texts_of(df)
        prints = [fingerprint(t) for _, t in rows]
        least = {}
        for (i, _), r in zip(rows, reachable(prints)):
            if i is not None:
                least[r] = min(i, least.get(r, i))
        want = Counter((i, p, least.get(r)) for (i, _), p, r in zip(rows, prints, reachable(prints)))
        got = simhash.near_duplicates(df).collect()
        assert Counter((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got) == want
    assert simhash.near_duplicates(none).count() == 0


def test_one_of_each_group_stays(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    found = simhash.near_duplicates(odd.where("doc_id IS NOT NULL")).collect()
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r.component_id for r in found}) and ids.count(None) == 1


# --- 8: shards ----------------------------------------------------------------------------------


def test_shards(documents, odd, none):
    for df in (documents, odd):
        rows = sharding.balanced_shards(df).collect()
        want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts_of(df))
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
        slots = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
        assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
        total, largest = sum(r.size for r in rows), max(r.size for r in rows)
        for s in range(40):
            size = sum(r.size for r in rows if r.shard == s)
            assert abs(size - total / 40) <= largest + total / 4000
    assert sharding.balanced_shards(none).count() == 0


def test_copies_stay_together(spark):
    rows = [(k, f"text {k % 3000:05d}") for k in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    shards = {}
    for r in sharding.balanced_shards(df, shards=4).collect():
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_sharding_runs_no_python(spark):
    plan = QUERIES["op8_sharding"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


# --- 9: licences -------------------------------------------------------------------------------------


def test_licences(spark, odd, none):
    mit = licenses.TEXTS["MIT"]
    broken = "\n".join(mit[k : k + 70] for k in range(0, len(mit), 70))
    rows = [
        (1, "Some text.\nLicensed under CC BY-NC 4.0.\nMore."),
        (2, "Licensed under CC BY-SA 4.0"),
        (3, f"prose of no kind\n\n{broken}\n\nprose"),
        (4, "The license of this work was lost."),
        (5, "ALL RIGHTS RESERVED"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.scope, r.licence) for r in licenses.scan_licences(df).collect()}
    assert got == {
        (1, "line", "CC-BY-NC-4.0"), (2, "line", "CC-BY-SA-4.0"), (3, "run", "MIT"), (5, "line", "All-Rights-Reserved")
    }
    assert licenses.scan_licences(odd).count() == 0 and licenses.scan_licences(none).count() == 0


def licences_in(spark, text):
    rows = licenses.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    return sorted((r.scope, r.first_line, r.last_line, r.licence) for r in rows)


def test_notices_inside_and_across_lines(spark):
    mit = licenses.TEXTS["MIT"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    assert licences_in(spark, mit) == [("window", 0, 4, "MIT")]
    inside = "It was a fine day. Licensed under the Apache License, Version 2.0."
    assert licences_in(spark, inside) == [("window", 0, 0, "Apache-2.0")]
    prose = "They went out of the house in the morning and came to the end of the road. " * 3
    assert licences_in(spark, f"{prose}\n{prose} {inside} {prose}") == [("window", 1, 1, "Apache-2.0")]
    assert licences_in(spark, f"{prose}\n{mit}\n{prose}\nAll rights reserved. {prose}") == [
        ("window", 1, 5, "MIT"), ("window", 7, 7, "All-Rights-Reserved")
    ]
    assert licences_in(spark, "of the " * 3000 + prose) == []


def test_standard_texts_are_found_as_themselves(spark):
    texts = [*licenses.TEXTS.items(), *licenses.STANDARD_TEXTS]
    assert set(licenses.LICENCES) <= {licence for licence, _ in texts}
    rows = []
    for k, (_, text) in enumerate(texts):
        words = text.split()
        wrapped = "\n".join(" ".join(words[i : i + 11]) for i in range(0, len(words), 11))
        rows += [(3 * k, text), (3 * k + 1, wrapped), (3 * k + 2, f"First prose. {text} The end of the text.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in licenses.scan_licences(df).collect():
        got.setdefault(r.doc_id, []).append((r.last_line - r.first_line, r.dice, r.licence))
    for doc, text in rows:
        assert max(got[doc])[2] == texts[doc // 3][0], text
    # The disclaimers and the version of the GNU licences count.
    gpl = dict(licenses.STANDARD_TEXTS[::-1])["GPL-2.0"]
    assert [x[-1] for x in licences_in(spark, gpl)] == ["GPL-2.0"]


def test_size_bounds_prune_nothing_that_matches():
    sets = [licenses.bigrams(t) for _, t in licenses.TEMPLATES]
    for _, text in licenses.TEMPLATES:
        for cut in (0, 1, 3):
            piece = licenses.bigrams(" ".join(text.split()[cut:]))
            scores = [2 * len(piece & s) / max(1, len(piece) + len(s)) for s in sets]
            best = licenses.best_template(piece, sets, 0.8)
            assert (best[1] if best else None) == (max(scores) if max(scores) >= 0.8 else None)


# --- 10: repetition ------------------------------------------------------------------------------------


def repetition_of(text, least=repetition.LEAST_REPEAT):
    w = words(text)
    covered, longest = set(), 0
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            n = 0
            while j + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= least:
                covered.update(range(i, i + n), range(j, j + n))
                longest = max(longest, n)
    return len(covered), longest


def test_repetition(documents, odd, none):
    for df in (documents.where("n_chars < 2000"), odd):
        rows = repetition.repetition(df).collect()
        texts = {}
        for i, t in texts_of(df):
            texts.setdefault(i, []).append(t)
        for r in rows:
            t = texts[r.doc_id][0] or ""
            w = t.encode().split()
            grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
            twice = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
            lines = Counter(x for x in t.split("\n") if x.encode().split())
            assert (r.n_words, r.word_chars) == (len(w), sum(len(x.decode()) for x in w))
            assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t))
            assert r.n_dup_lines == sum(lines.values()) - len(lines)
            assert r.n_repeat_words == len(twice)
            assert (r.repeat_covered, r.longest_repeat) == repetition_of(t)
    assert repetition.repetition(none).count() == 0


def test_kept_documents_are_the_judged_ones(documents, odd):
    for df in (documents, odd):
        judged = Counter(r.doc_id for r in repetition.judged(df).where("kept").collect())
        kept = repetition.keep_judged(df)
        assert Counter(r.doc_id for r in kept.collect()) == judged and kept.columns == df.columns


# --- the registered queries ------------------------------------------------------------------------------


def test_digests(spark, documents):
    kept = {r.doc_id: r for r in QUERIES["op1_substring_dedup"](spark, SMALL).collect()}
    for doc, n, gone, text in without_repeats(texts_of(documents), 35):
        assert tuple(kept[doc]) == (doc, n, gone, hashlib.sha256(text.encode()).hexdigest())
    texts = dict(texts_of(documents))
    for r in QUERIES["op2_pii"](spark, SMALL).collect():
        base = base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(k == kind for k, _, _ in base) for kind in PATTERNS
        )
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    for r in QUERIES["op7_simhash"](spark, SMALL).collect():
        assert r.fingerprint == f"{fingerprint(texts[r.doc_id]):016x}"


def test_tokens_agree(spark):
    a = {r.doc_id: r.n_tokens for r in QUERIES["op4_token_files"](spark, SMALL).collect()}
    pieces = QUERIES["op6_packing"](spark, SMALL).groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens"))
    assert {r[0]: (r[1], r[2]) for r in pieces.collect()} == {k: (v, v) for k, v in a.items()}
