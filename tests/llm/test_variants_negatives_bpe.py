"""Spelling variants, hard negatives and the pair-index encoding against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from odd_rows import documents, none, odd  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casewright.llm import bpe, negatives, packing, spelling
from casewright.llm.queries import QUERIES
from casewright.llm.tokens import Encoder, tokenizer_path


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- 11: spelling variants ---------------------------------------------------------


def counted(texts, every=199):
    count = Counter()
    lower = {k: k + 32 for k in range(65, 91)}
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(lower)
            h = zlib.crc32(f"{doc}:{w}".encode())
            if doc is not None and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 6:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def variants(count, factor=5):
    dropped = {}
    for w in count:
        for k in range(len(w)):
            dropped.setdefault(w[:k] + w[k + 1 :], set()).add(w)
    out = {}
    for w in count:
        close = {u for k in range(len(w)) for u in dropped[w[:k] + w[k + 1 :]]}
        close |= dropped.get(w, set()) | {w[:k] + w[k + 1 :] for k in range(len(w))}
        close = [u for u in close if u in count and near(u, w)]
        best = min(close, key=lambda u: (-count[u], u), default=None)
        form = best if best and count[best] >= factor * count[w] else None
        out[w] = (form, count[w], len(close), count[form] if form else None)
    rows = set()
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, n_near, form_n))
    return rows


def rows_of(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("every", [3, 199])
def test_words_are_counted_with_their_damage(documents, odd, every):
    for df in (documents, odd):
        got = {r.word: r.n for r in spelling.observed_words(df, every=every).collect()}
        assert got == counted(texts_of(df), every)


def test_variants_of_dense_words(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abÀ") for _ in range(rng.randint(1, 7))) for _ in range(700)}
    words |= {"a" * k for k in range(1, 12)} | {"x" * 300 + t for t in ("", "a", "b", "ab", "ba", "bab", "aab")}
    words |= {"y" * 5000 + "z", "y" * 4999 + "z", "y" * 5000, "w" * 4000 + "q" * 40 + "w" * 100}
    count = {w: rng.randint(1, 400) for w in words}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    got = spelling.spelling_variants(spelling.stored_words(df))
    assert rows_of(got) == variants(count)
    pairs = [(r.word, r.near) for r in spelling.near_pairs(df).collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs})


def test_variants_of_documents(spark, documents, odd, none):
    rows = QUERIES["op11_spelling_variants"](spark, SMALL)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = variants(counted(texts_of(documents)))
    assert any(form for _, form, *_ in expected)
    assert rows_of(rows) == expected
    for df in (odd, none):
        words = spelling.stored_words(spelling.observed_words(df))
        assert rows_of(spelling.spelling_variants(words)) == variants(counted(texts_of(df)))


# --- 12: hard negatives ------------------------------------------------------------


def mined(rows, is_anchor, positives=5, count=10):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score as sorted rows."""

    def product(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for i, (a, label, v) in enumerate(rows):
        if not is_anchor(a):
            continue
        scored = sorted((-product(v, u), b, k) for k, (b, _, u) in enumerate(rows))
        same = [x for x in scored if x[2] != i and rows[x[2]][1] == label][:positives]
        other = [x for x in scored if rows[x[2]][1] != label]
        for p, b, _ in same:
            fitting = [x for x in other if 30 * -p <= 100 * -x[0] <= 90 * -p][:count]
            out += [(a, b, r, x[1], -p, -x[0]) for r, x in enumerate(fitting, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_negatives_of_embeddings(spark):
    got = found(QUERIES["op12_hard_negatives"](spark, SMALL))
    rows = [
        (r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label,
         [int(np.floor(256 * np.float64(x))) for x in r.embedding])
        for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ]
    assert got == mined(rows, lambda a: a % 100 == 0)
    assert got


@pytest.mark.parametrize("big", [1, 10**7])
def test_negatives_of_odd_rows(spark, monkeypatch, big):
    """Ties, repeated rows, zeros, short vectors, nulls, one hot label, several passes and blocks."""
    monkeypatch.setattr(negatives, "PASS_ANCHORS", 7)
    monkeypatch.setattr(negatives, "TOGETHER", 3)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    rng = random.Random(9)
    rows = []
    for k in range(240):
        label = 0 if k % 3 else rng.randint(1, 4)
        size = 6 if k % 11 else rng.randint(0, 5)
        rows.append((k // 2 * 2 if k % 5 == 0 else k, label, [rng.randint(-3, 3) * big / 256 for _ in range(size)]))
    rows += [(6, 0, [0.0] * 6), (12, 1, [0.0] * 6), (18, 2, []), (24, 7, [1.0] * 6)]
    rows += rows[30:40]
    bad = [(None, 1, [1.0] * 6), (30, None, [1.0] * 6), (36, 1, None), (42, 1, [1.0, None]), (48, 1, [float("nan")]),
           (54, 1, [float("inf"), 1.0]), (60, 1, [1e308])]
    df = spark.createDataFrame([(*r, 0, 0.5) for r in rows + bad],
                               "vec_id long, label int, embedding array<double>, uid int, score double")
    stored = negatives.stored_rows(negatives.scaled_rows(df.repartition(3)))
    got = negatives.hard_negatives(stored, stored.where("vec_id % 6 = 0"))
    whole = [(i, c, [int(np.floor(256 * x)) for x in v]) for i, c, v in rows]
    expected = mined(whole, lambda a: a % 6 == 0)
    assert expected
    assert found(got) == expected


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    stored = negatives.stored_rows(negatives.scaled_rows(df))
    assert found(negatives.hard_negatives(stored, stored)) == []


def test_threshold_leaves_rows_unread():
    """Rows of one far cluster are not read for anchors of another once their windows are full."""
    rng = np.random.default_rng(3)
    near, far = rng.integers(80, 100, (200, 8)), rng.integers(-100, -80, (800, 8))
    vector = np.concatenate([near, far]).astype(float)
    ids = np.arange(1000)
    block = negatives.Block(ids, ids, np.zeros(1000, np.int64), vector)
    top, no = np.full(1, 2**63 - 1), np.full(1, negatives.EMPTY)
    first = np.zeros(1, np.int64)
    anchors = negatives.Anchors(ids[:1], first, vector[:1], first, first, no, top)
    best = negatives.Best(1, 5)
    assert block.search(anchors, np.array([0]), best, True) < 300
    scores = vector @ vector[0]
    order = np.lexsort((ids[1:], -scores[1:]))[:5] + 1
    assert best.vec_id[0].tolist() == order.tolist()


# --- 13: byte-pair encoding ----------------------------------------------------------

SPECIAL = ["<|endoftext|>", "x<|endoftext|>y", "a <|endoftext|><|endoftext|> it's we'll", "end<|endoftext|>",
           "<|endof", "text|>", "<|endoftext|<|endoftext|>. 9.<|endoftext|>,b", "<|endoftext|> " * 300]
ALPHABET = ["a", "b", "<|endoftext|>", " ", "  ", "\n", "é", "日", "'s", "'ll", ".", "1", "<|", "|>", "🙂", " ",
            "　", "\x85", "T", "the", " of", "\t", "\r\n", "!!", "́", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(1)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(4000)]


def test_pair_index_has_the_ids_of_the_library(library, documents, odd, mixed):
    encoder, decoder = bpe.PairEncoder(tokenizer_path()), bpe.Decoder(tokenizer_path())
    texts = [t or "" for _, t in texts_of(documents) + texts_of(odd)] + SPECIAL + mixed
    texts += ["a" * 9999, "ab" * 5000, " " * 5000, "aaaab" * 3000]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    groups = [pa.array(texts[k : k + 900]) for k in range(0, len(texts), 900)]
    got = [np.frombuffer(x, "<u4").tolist() for ids in encoder.encode_all(groups) for x in ids]
    assert got == expected
    back = decoder.decode(pa.array([np.array(x, "<u4").tobytes() for x in expected], pa.binary()))
    assert back == [library.decode(x, skip_special_tokens=False) for x in expected]


def test_decoding_of_odd_ids(library):
    rng = random.Random(4)
    rows = [[rng.randrange(50_257) for _ in range(30)] for _ in range(500)] + [[], [50_256, 70_000, 1]]
    column = pa.array([np.array(x, "<u4").tobytes() for x in rows] + [None], pa.binary())
    expected = [library.decode(x, skip_special_tokens=False) for x in rows] + [""]
    assert bpe.Decoder(tokenizer_path()).decode(column) == expected


def test_merges_of_any_rank_order(tmp_path):
    """Merges whose parts come later in the list are applied as the library does."""
    import json

    letters = bpe.byte_letters()
    tokens = [*letters, "abc", "bc", "ab", "aa", "aaaa", "aab"]
    merges = [["a", "bc"], ["aa", "aa"], ["b", "c"], ["a", "a"], ["a", "b"], ["a", "ab"]]
    with open(tokenizer_path(), encoding="utf-8") as file:
        content = json.load(file)
    content["model"].update(vocab={t: i for i, t in enumerate(tokens)}, merges=merges)
    content["added_tokens"] = []
    path = tmp_path / "small.json"
    path.write_text(json.dumps(content))
    rng = random.Random(2)
    texts = ["".join(rng.choice("aaabc ") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    expected = [e.ids for e in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]
    got = bpe.PairEncoder(str(path)).encode(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == expected


def test_digests_of_encoded_documents(spark, documents, odd, none, library):
    got = {r.doc_id: r for r in QUERIES["op13_pair_index_bpe"](spark, SMALL).collect()}
    for doc, text in texts_of(documents):
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = got.pop(doc)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert not got
    back = bpe.decode_ids(bpe.encode_texts(odd)).select("doc_id", "text").collect()
    assert Counter(map(tuple, back)) == Counter((i, t or "") for i, t in texts_of(odd))
    assert bpe.decode_ids(bpe.encode_texts(none)).count() == 0


def test_special_strings_are_one_id_everywhere(spark, library, mixed):
    """The stored and packed ids are the library's, wherever a special string stands."""
    texts = SPECIAL + mixed
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = Encoder(tokenizer_path()).encode(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [[*x, 0] for x in expected]
    df = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    packed = packing.pack(df, window=4).groupBy("doc_id").agg(F.max("doc_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {k: len(expected[k]) + 1 for k in range(len(SPECIAL))}
