from __future__ import annotations

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.functions import embedding, language
from casewright.operators import context, evaluation, language_model, ranking, search, vector_index
from casewright.plans.settings import LSH_BITS, LSH_TABLES
from casewright.session import shared_folder


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((60, 8))
    # a third of all rows are copies of one vector, and one vector is zero
    base[:20] = base[0]
    base[30] = 0.0
    data = [(i, [float(x) for x in v], i % 4) for i, v in enumerate(base)]
    corpus = spark.createDataFrame(data, "id bigint, vector array<float>, label int")
    asked = rng.standard_normal((7, 8))
    asked[0] = base[0]
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(asked)], "query_id bigint, vector array<double>"
    )
    return corpus.repartition(6), queries, base.astype(np.float32).astype(float), asked


def brute(base, asked, k, metric, allowed=lambda i: True):
    out = []
    for q, v in enumerate(asked):
        scored = []
        for i, b in enumerate(base):
            if not allowed(i):
                continue
            dot = float(b @ v)
            if metric == "cosine":
                n = math.sqrt(b @ b) * math.sqrt(v @ v)
                s = dot / n if n else 0.0
            else:
                s = dot if metric == "dot" else -float(np.linalg.norm(b - v))
            scored.append((-round(s, 9), i))
        out += [(q, i, r) for r, (_, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
@pytest.mark.parametrize("whole", [True, False])
def test_vector_search_is_exact(vectors, monkeypatch, metric, whole):
    corpus, queries, base, asked = vectors
    monkeypatch.setattr(search, "SCORED_QUERIES", 3)
    hits = search.vector_search(
        corpus, queries, 25, metric, query_bytes=search.QUERY_BYTES if whole else 1000
    )
    assert rows(hits, "query_id", "id", "rank") == brute(base, asked, 25, metric)


def test_vector_search_filters_first(vectors):
    corpus, queries, base, asked = vectors
    for filters in ({"label": 3}, "label = 3", F.col("label") == 3):
        hits = search.vector_search(corpus, queries, 5, filters=filters)
        expected = brute(base, asked, 5, "cosine", lambda i: i % 4 == 3)
        assert rows(hits, "query_id", "id", "rank") == expected
    assert search.vector_search(corpus, queries, 5, filters="label > 99").count() == 0
    assert search.vector_search(corpus, queries.limit(0), 5).count() == 0


def test_no_pairs_are_shuffled(vectors):
    corpus, queries, *_ = vectors
    plan = search.vector_search(corpus, queries, 5)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_centroids(vectors):
    corpus, _, base, _ = vectors
    got = {r.query_id: r.vector for r in search.label_centroids(corpus).collect()}
    for label in range(4):
        assert np.allclose(got[label], base[label::4].mean(0))


def embeddings(spark, folder):
    v = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    return v, v.where("id % 20 = 0").withColumnRenamed("id", "query_id")


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_hyperplane_buckets_recall(spark, folder):
    v, q = embeddings(spark, folder)
    exact = set(rows(search.vector_search(v, q, 10), "query_id", "id"))
    codes = embedding.plane_codes(F.col("vector"), 64, LSH_TABLES, LSH_BITS)
    coded, asked = v.withColumn("codes", codes), q.withColumn("codes", codes)
    near = set(rows(search.approximate_search(coded, asked, 10), "query_id", "id"))
    assert len(exact & near) / len(exact) >= 0.9


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_cells_recall(spark, folder):
    v, q = embeddings(spark, folder)
    exact = set(rows(search.vector_search(v, q, 10), "query_id", "id"))
    model = vector_index.fit(v)
    index = vector_index.build(v, model, shared_folder(spark, "cells"))
    near = set(rows(vector_index.cell_search(index, q, model, 10), "query_id", "id"))
    assert len(exact & near) / len(exact) >= 0.9
    # Vectors are read for a short list, codes for part of the rows.
    pairs = v.count() * q.count()
    few = vector_index.short_list(index, q, model, 40)
    assert few.count() < 0.1 * pairs
    met = vector_index.rows_met(index, q, model).agg(F.sum("rows")).first()[0]
    assert few.count() < met < 0.75 * pairs
    plan = vector_index.short_list(index, q, model, 40)._jdf.queryExecution().toString()
    scan = next(x for x in plan.splitlines()[::-1] if "FileScan parquet" in x)
    assert "vector" not in scan.split("ReadSchema")[1]


def test_cells_of_clusters(spark):
    """Clustered rows, one cluster with half of them: a query meets its own cluster alone."""
    rng = np.random.default_rng(11)
    centre = np.eye(16)[:8] * 10
    label = np.where(rng.random(2000) < 0.5, 0, rng.integers(0, 8, 2000))
    base = centre[label] + rng.standard_normal((2000, 16)) * 0.5
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(base)], "id long, vector array<double>")
    model = vector_index.fit(df, cells=32)
    index = vector_index.build(df, model, shared_folder(spark, "cells"))
    q = df.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    exact = set(rows(search.vector_search(df, q, 10), "query_id", "id"))
    near = set(rows(vector_index.cell_search(index, q, model, 10), "query_id", "id"))
    assert len(exact & near) / len(exact) >= 0.9
    own = Counter(label.tolist())
    met = {r.query_id: r.rows for r in vector_index.rows_met(index, q, model).collect()}
    assert all(met[i] <= 1.05 * own[label[i]] for i in met)


def test_cells_of_odd_rows(spark):
    """Null and zero vectors, copies and an empty table."""
    data = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 2.0])]
    df = spark.createDataFrame(data, "id long, vector array<double>")
    q = df.withColumnRenamed("id", "query_id")
    for rows_ in (df, df.where("id < 0")):
        model = vector_index.fit(rows_, target=1.0)
        index = vector_index.build(rows_, model, shared_folder(spark, "cells"))
        got = rows(vector_index.cell_search(index, q, model, 2), "query_id", "id", "rank")
        want = {(1, 1, 1), (1, 4, 2), (4, 1, 1), (4, 4, 2), (5, 5, 1)} if rows_ is df else set()
        assert want <= set(got)
        assert {x[0] for x in got} == ({1, 3, 4, 5} if want else set())


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_approximate_search_scores_like_exact(vectors, metric):
    corpus, queries, base, asked = vectors
    one = F.array(F.lit(0))
    hits = search.approximate_search(corpus.withColumn("codes", one), queries.withColumn("codes", one), 5, metric)
    assert rows(hits, "query_id", "id", "rank") == brute(base, asked, 5, metric)


def test_rows_without_a_vector_are_passed_over(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id long, vector array<double>")
    asked = spark.createDataFrame([(7, [1.0, 0.0]), (8, None)], "query_id long, vector array<double>")
    assert rows(search.vector_search(corpus, asked, 3), "query_id", "id") == [(7, 1)]


TEXTS = ["the cat sat", "the the dog", "", "a cat and a dog", "the", "fish"] + ["the copy text"] * 6


def py_bm25(texts, question, k1=1.2, b=0.75):
    docs = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    out = {}
    for t in set(re.findall(r"[^\W_]+", question.lower())):
        df = sum(t in d for d in docs)
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        for i, d in enumerate(docs):
            if t in d:
                tf = d.count(t)
                out[i] = out.get(i, 0) + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(d) / mean))
    return [i for _, i in sorted((-round(s, 9), i) for i, s in out.items())]


@pytest.mark.parametrize("whole", [True, False])
def test_keyword_search_is_exact(spark, monkeypatch, whole):
    monkeypatch.setattr(search, "SCORED_QUERIES", 2)
    monkeypatch.setattr(search, "HIT_BYTES", search.HIT_BYTES if whole else 0)
    corpus = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string").repartition(4)
    asked = ["the cat", "dog dog Dog", "unknown words", "", "copy"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id bigint, text string")
    hits = search.keyword_search(
        corpus, queries, 4, query_bytes=search.QUERY_BYTES if whole else 1000
    )
    expected = [
        (q, i, r) for q, text in enumerate(asked) for r, i in enumerate(py_bm25(TEXTS, text)[:4], 1)
    ]
    assert rows(hits, "query_id", "id", "rank") == sorted(expected)


def ranked(spark, *hits):
    return spark.createDataFrame(hits, "query_id int, id int, rank int, score double")


def test_fusion(spark):
    a = ranked(spark, (1, 10, 1, 0.9), (1, 11, 2, 0.5), (2, 10, 1, 0.1))
    b = ranked(spark, (1, 11, 1, 8.0), (1, 12, 2, 4.0))
    fused = search.fuse_ranks([a, b], 2)
    assert rows(fused, "query_id", "rank", "id") == [(1, 1, 11), (1, 2, 10), (2, 1, 10)]
    weighted = {
        (r.query_id, r.id): r.score for r in search.fuse_scores([(a, 0.6), (b, 0.4)], 9).collect()
    }
    assert weighted[(1, 10)] == pytest.approx(0.6)
    assert weighted[(1, 11)] == pytest.approx(0.6 * 5 / 9 + 0.4)
    merged = search.best_rank_union([a, b], 2)
    assert rows(merged, "query_id", "rank", "id", "votes") == [(1, 1, 11, 2), (1, 2, 10, 1), (2, 1, 10, 1)]


def test_rerank(spark):
    corpus = spark.createDataFrame([(1, "x y"), (2, "a b"), (3, "a")], "id int, text string")
    queries = spark.createDataFrame([(1, "a b")], "query_id int, text string")
    pool = ranked(spark, (1, 1, 1, 9.0), (1, 3, 2, 8.0), (1, 2, 3, 7.0))
    assert rows(search.rerank(pool, corpus, queries, 2), "rank", "id") == [(1, 2), (2, 3)]
    assert rows(search.rerank(pool, corpus, queries, 2, pool=2), "rank", "id") == [(1, 3), (2, 1)]


def test_context_order(spark):
    hits = [(q, i, i + 1, 0.0) for q, n in ((1, 5), (2, 3), (3, 2), (4, 1)) for i in range(n)]
    got = rows(context.order_for_attention(ranked(spark, *hits)), "query_id", "position", "id")
    assert got == [(1, 1, 0), (1, 2, 2), (1, 3, 3), (1, 4, 1), (2, 1, 0), (2, 2, 1),
                   (3, 1, 0), (3, 2, 1), (4, 1, 0)]
    kept = rows(context.order_for_attention(ranked(spark, *hits), True), "query_id", "position", "id")
    assert [i for q, _, i in kept if q == 1] == [0, 2, 3, 4, 1]


def test_context_helpers(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "a" * 40), (1, 2, 2, "b" * 8), (1, 3, 3, "c" * 400)],
        "query_id int, id int, rank int, text string",
    )
    assert rows(context.within_budget(df, 12), "rank", "used_tokens") == [(1, 10), (2, 12)]
    assert context.available_tokens(128_000, 200, 100, 2000) == 125_700
    block = context.passage_block(F.col("rank"), F.col("id"), F.lit("case_1"), F.lit("t"))
    (row,) = context.assemble(df, block).collect()
    assert row.sources == 3 and row.context.split("\n---\n")[1] == "ID 2: 2\nCase ID: case_1\nContent: t"


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "a b c d"), (1, 2, 2, "D c b a"), (1, 3, 3, "x y"), (2, 2, 1, "a b c d")],
        "query_id int, id int, rank int, text string",
    )
    assert rows(context.without_near_duplicates(df, 0.9), "query_id", "id") == [(1, 1), (1, 3), (2, 2)]
    corpus = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    got = rows(context.drop_exact_duplicates(corpus), "id", "copies")
    assert got == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 6)]


def test_hot_keys_join_like_any_other(spark):
    left = spark.createDataFrame(
        [("hot" if i % 3 else f"k{i % 9}", i) for i in range(300)] + [("lost", -1)], "key string, n int"
    )
    right = left.where("n >= 0").groupBy("key").agg(F.count("*").alias("c"))
    joined = context.join_hot(left, right, "key", F.col("c") > 100, F.xxhash64("n"))
    assert rows(joined, "key", "n", "c") == rows(left.join(right, "key"), "key", "n", "c")


def test_positions_with_a_hot_group(spark):
    data = [(0 if i % 3 else i, (i * 37) % 500, i) for i in range(500)] + [(None, 5, 900), (None, 5, 901), (1, None, 902)]
    df = spark.createDataFrame(data, "g int, t bigint, tie int")
    got = rows(ranking.position_in_group(df, "g", "t", "tie").na.fill(-1), "g", "t", "tie", "position")
    expected, seen = [], {}
    for g, t, tie in sorted((-1 if g is None else g, -1 if t is None else t, tie) for g, t, tie in data):
        seen[g] = seen.get(g, 0) + 1
        expected.append((g, t, tie, seen[g]))
    assert got == expected
    assert ranking.position_in_group(df.where("tie < 0"), "g", "t", "tie").count() == 0


def test_one_value_of_the_order_is_spread(spark):
    """A third of all rows in one group, all of them with one timestamp: no task has more than its share."""
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("g"), F.lit(7).alias("t"), F.col("id").alias("tie")
    )
    asked = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.position_in_group(df, "g", "t", "tie")
        hot = got.where("g = 0").orderBy("tie").collect()
        folder = next(f for f in got.inputFiles()).rsplit("/", 1)[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", asked)
    assert [r.position for r in hot] == list(range(1, len(hot) + 1))
    parts = spark.read.parquet(folder).groupBy("_part").count().collect()
    assert max(r["count"] for r in parts) < 2 * n / 8


def test_summary_picks_rare_sentences(spark):
    df = spark.createDataFrame(
        [(1, "The the. Zebra quagga! The the."), (2, "The the. ..."), (3, "")], "id int, text string"
    )
    got = rows(context.extractive_summary(df, 1), "id", "sentence_no", "sentence")
    assert got == [(1, 2, "Zebra quagga!"), (2, 1, "The the.")]


def test_summary_moves_no_word_of_a_frequent_term(spark):
    """Whatever part of the weights is sent to the words, the sentences are those of brute force."""
    rng = np.random.default_rng(4)
    names = [f"w{i}" for i in range(60)]
    texts = [" ".join(" ".join(rng.choice(names, rng.integers(0, 5))) + "." for _ in range(rng.integers(0, 5))) for _ in range(40)]
    data = [(i // 2 if i < 6 else i, t) for i, t in enumerate(texts)] + [(90, None), (None, "w1 w2. w3")]
    df = spark.createDataFrame(data, "id int, text string")
    found = [set(re.findall("[a-z0-9]+", t or "")) for _, t in data]
    idf = {w: math.log(len(data) / sum(w in f for f in found)) for f in found for w in f}
    said = [(i, p, s.strip()) for i, t in data if t is not None for p, s in enumerate(re.split(r"(?<=[.!?])\s+", t), 1)]
    mean = {}
    for i, p, s in said:
        mean.setdefault((i, p), []).extend(idf[w] for w in re.findall("[a-z0-9]+", s))
    mean = {k: round(sum(v) / len(v), 9) for k, v in mean.items() if v}
    best = {i: sorted((-v, p) for (j, p), v in mean.items() if j == i)[:2] for i, _ in mean}
    want = sorted((i, p, s) for i, p, s in said if i is not None and p in [x for _, x in best.get(i, [])])
    for size in (1 << 20, 1_000, 0):
        got = context.extractive_summary(df, 2, size)
        assert rows(got, "id", "sentence_no", "sentence") == want
        assert all(r.score == pytest.approx(mean[r.id, r.sentence_no], abs=2e-9) for r in got.collect())
    plan = context.extractive_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*(term|_key)", plan)


def test_retrieval_metrics(spark):
    hits = spark.createDataFrame(
        [(1, 1, False), (1, 2, True), (1, 3, True), (2, 1, False)], "query_id int, rank int, relevant boolean"
    )
    totals = spark.createDataFrame([(1, 4), (2, 1), (3, 1)], "query_id int, total_relevant bigint")
    got = {r.query_id: r for r in evaluation.retrieval_metrics(hits, totals, 3).collect()}
    assert (got[1].precision, got[1].recall, got[1].mrr) == (pytest.approx(2 / 3), 0.5, 0.5)
    ideal = 1 + 1 / math.log2(3) + 0.5
    assert got[1].ndcg == pytest.approx((1 / math.log2(3) + 0.5) / ideal)
    assert (got[2].mrr, got[2].ndcg, got[3].recall) == (0.0, 0.0, 0.0)


def test_text_overlap(spark):
    df = spark.createDataFrame(
        [(1, "the cat is on the mat", "the cat sat on the mat"), (2, "a b", "A, b!"), (3, "", "x"), (4, "q", "")],
        "pair_id int, candidate string, reference string",
    )
    got = {r.pair_id: r for r in evaluation.text_overlap_metrics(df).collect()}
    assert got[1].token_f1 == pytest.approx(10 / 12) and got[1].rouge1 == pytest.approx(5 / 6)
    assert got[2].exact_match and not got[1].exact_match and got[3].token_f1 == 0.0
    bleu = {r.pair_id: r.bleu for r in evaluation.bleu(df, 2).collect()}
    assert bleu[1] == pytest.approx(math.sqrt(5 / 6 * 3 / 5)) and bleu[2] == 1.0 and bleu[3] == 0.0


def test_result_rows(spark):
    df = spark.createDataFrame([(["a", "b"], ["1", "2", "3"]), (["a", "b"], ["1"])], "n array<string>, r array<string>")
    got = [r[0] for r in df.select(search.result_rows(F.col("n"), F.col("r"))).collect()]
    assert got == [{"a": "1", "b": "2"}, {"a": "1"}]


def test_embeddings(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, "b a a")], "id int, text string")
    got = {r[0]: r[1] for r in df.select("id", embedding.hash_embedding(F.col("text"), 16)).collect()}
    assert got[1] == got[3] and sum(x * x for x in got[1]) == pytest.approx(1.0)
    assert got[2] == [0.0] * 16
    tfidf = {r.id: r.vector for r in embedding.tfidf_embedding(df, dims=32).collect()}
    assert sum(x * x for x in tfidf[1]) == pytest.approx(1.0) and sum(tfidf[2]) == 0


def test_diverse_summary(spark):
    data = [
        (1, "Zebra quagga okapi lion tiger bear wolf fox. Zebra quagga okapi lion tiger bear wolf. The sun rises over a green hill today."),
        (2, "..."),
        (3, None),
        (4, "One. One. One."),
    ] + [(k, f"The the of and to filler{k} a in.") for k in range(10, 30)]
    df = spark.createDataFrame(data, "id int, text string")
    got = rows(context.diverse_summary(df, 2), "id", "sentence_no")
    # The second sentence repeats the first one, so the third is taken.
    assert [x for x in got if x[0] == 1] == [(1, 1), (1, 3)]
    assert not [x for x in got if x[0] in (2, 3)]
    assert [x for x in got if x[0] == 4] == [(4, 1), (4, 2)]
    assert context.diverse_summary(df.where("id < 0"), 2).count() == 0


def test_chosen_sentences_against_brute_force():
    rng = np.random.default_rng(2)
    idf = rng.random(50)
    for _ in range(200):
        words = [rng.integers(0, 50, rng.integers(0, 12)).tolist() for _ in range(rng.integers(0, 9))]
        score = {p: round(np.mean(idf[w]) * (1 + 1 / (p + 1)) * min(1, len(w) / 8), 9) for p, w in enumerate(words) if w}
        taken = []
        while len(taken) < 3 and len(taken) < len(score):
            def worth(p):
                like = max((len(set(words[p]) & set(words[q])) / len(set(words[p]) | set(words[q])) for q in taken), default=0)
                return round(0.7 * score[p] - (1 - 0.7) * like * max(score.values()), 9)
            taken.append(min((p for p in score if p not in taken), key=lambda p: (-worth(p), p)))
        got = context.chosen_sentences(words, idf, 3, 0.7)
        assert [p for p, _ in got] == sorted(taken)


def test_language_of_held_out_texts(spark):
    """Fitted on fifty texts of each language, the model names the language of the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("id"), "text", "lang")
    sample = language_model.sampled(docs, 50)
    model = language_model.fit(sample)
    rest = docs.join(sample.select("id"), "id", "left_anti").where("length(text) >= 40")
    found = language_model.detect(rest, model).withColumnRenamed("lang", "detected")
    told = rest.join(found, "id").select("lang", "detected").collect()
    right = sum(r.lang == r.detected for r in told) / len(told)
    stop = rest.select("lang", language.detect_language(F.col("text")).alias("detected")).collect()
    assert len(told) > 400
    assert right >= 0.95 and right >= sum(r.lang == r.detected for r in stop) / len(stop)


def test_language_of_odd_texts(spark):
    df = spark.createDataFrame(
        [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "123 !!", None), (5, "", "fr")],
        "id int, text string, lang string",
    )
    model = language_model.fit(language_model.sampled(df))
    got = {r.id: r.lang for r in language_model.detect(df, model).collect()}
    assert got == {1: "en", 2: "fr", 3: None, 4: None, 5: None}
    assert language_model.detect(df.where("id < 0"), model).count() == 0


def test_candidate_counts_are_those_of_the_pairs(spark):
    rng = np.random.default_rng(3)
    codes = [(i % 700, rng.integers(0, 4, 3).tolist()) for i in range(900)] + [(None, [0, 1, 2]), (5, None)]
    corpus = spark.createDataFrame(codes, "id long, codes array<int>")
    queries = corpus.where("id % 3 = 0").union(spark.createDataFrame([(9999, [7, 7, 7])], corpus.schema))
    queries = queries.withColumnRenamed("id", "query_id")
    pairs = search.candidate_pairs(corpus, queries).groupBy("query_id").count()
    for size in (search.QUERY_BYTES, 2_000):
        got = search.candidate_counts(corpus, queries, size)
        assert rows(got, "query_id", "scored") == rows(pairs, "query_id", "count")
    # No pair of a query and a row is shuffled.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    many = spark.createDataFrame([(0, [[0, 1, 2]] * 2)], "query_id long, c array<array<int>>")
    empty = search.candidate_counts(corpus.limit(0), many.select("query_id", F.explode("c").alias("codes")))
    assert empty.count() == 0


def test_ngrams_are_counted_where_the_texts_are(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 9))) for _ in range(600)]
    made = [(i // 2, texts[i], texts[-1 - i]) for i in range(300)] + [(500, None, "a b"), (501, "", None), (None, "a", "a")]
    pairs = spark.createDataFrame(made, "pair_id long, candidate string, reference string")

    def grams(text, n):
        words = (text or "").split()
        return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))

    want = []
    for pair in {p[0] for p in made}:
        for n in (1, 2, 3):
            c, r = (sum((grams(p[side], n) for p in made if p[0] == pair), Counter()) for side in (1, 2))
            if c or r:
                want.append((pair, n, (c & r).total(), c.total(), r.total()))
    got = evaluation.ngram_overlap(pairs, 3)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    # One shuffle of the texts by pair; n-grams are not rows that are grouped.
    final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange") == 1


def test_grams_of_long_texts_and_of_every_plane(spark):
    texts = ["a b", "", None, "𝐀𝐁𝐂 \u00e9t\u00e9", "ab " * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.g for r in df.select("id", language_model.grams(F.col("text")).alias("g")).collect()}
    for i, t in enumerate(texts):
        plain = None if t is None else " " + re.sub(r"[^\w]+", " ", t.lower()).strip() + " "
        want = plain and [plain[j : j + 3] for j in range(len(plain) - 2)]
        assert (got[i] or []) == list(dict.fromkeys(want or []))
    # No substring, whose time grows with its place in the text.
    plan = df.select(language_model.grams(F.col("text")))._jdf.queryExecution().analyzed().toString()
    assert "substr" not in plan


def test_a_gram_meets_one_row_of_the_model(spark):
    model = spark.createDataFrame(
        [(" ab", "x", 1.0), (" ab", "y", 1.0), ("ab ", "y", -0.5), ("zz ", "z", 2.0)], "gram string, lang string, weight double"
    )
    df = spark.createDataFrame([(1, "ab"), (2, "zz"), (3, "q"), (4, None), (1, "ab")], "id long, text string")
    got = language_model.detect(df, model)
    assert rows(got.fillna("", ["lang"]).fillna(0.0, ["score"]), "id", "lang", "score") == [
        (1, "x", 2.0), (1, "x", 2.0), (2, "z", 2.0), (3, "", 0.0), (4, "", 0.0)
    ]
    none = language_model.detect(df, model.limit(0))
    assert rows(none, "id", "lang") == rows(df.selectExpr("id", "cast(null as string) lang"), "id", "lang")


def test_products_with_the_centres_are_held_in_slices():
    """An Arrow batch of 10,000 rows and the most cells: all products at once would take over 300 MB."""
    random = np.random.default_rng(3)
    codes = random.integers(-127, 128, (10_000, 8)).astype(np.float64)
    centres = random.integers(-127, 128, (vector_index.MOST_CELLS, 8)).astype(np.float64)
    model = vector_index.Model(centres, 20_000)
    tracemalloc.start()
    cells = vector_index.nearest(codes, centres)
    looked = 0
    for q, cell in vector_index.cells_probed(codes, model):
        looked += len(q)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    some = np.r_[0:300, 9_900:10_000]
    assert (cells[some] == (codes[some] @ centres.T).argmax(1)).all()
    assert looked == sum(vector_index.probes(codes[a : a + 500], model).sum() for a in range(0, 10_000, 500))
    pairs = [np.stack(p, 1) for p in vector_index.cells_probed(codes[:600], model)]
    assert (np.concatenate(pairs) == np.argwhere(vector_index.probes(codes[:600], model))).all()


def test_keyword_search_of_a_long_text_among_many(spark):
    """The words of the long text times the number of texts are more than an int holds."""
    long, others = 1_100_000, 2_000
    text = F.when(F.col("id") == 0, F.repeat(F.lit("bolt "), long)).otherwise(F.lit("nut"))
    corpus = spark.range(others).select("id", text.alias("text"))
    asked = spark.createDataFrame([(1, "bolt")], "query_id bigint, text string")
    hit = search.keyword_search(corpus, asked, 3).first()
    weight = math.log1p((others - 1 + 0.5) / 1.5) * 2.2
    average = (long + others - 1) / others
    expected = weight * long / (long + 1.2 * 0.25 + 1.2 * 0.75 * long / average)
    assert hit.id == 0 and hit.score == pytest.approx(expected)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_approximate_search_ranks_the_pairs_without_making_them(spark, metric):
    """The hits are those of scored pairs, with ids that come twice, odd vectors and ids that are null."""
    rng = np.random.default_rng(5)
    odd = [None, [1.0, None, 2.0], [float("nan"), 1.0, 0.0], [0.0, 0.0, 0.0]]
    data = [(i % 60, rng.integers(-3, 4, 3).astype(float).tolist(), rng.integers(0, 5, 3).tolist()) for i in range(80)]
    data += [(70 + i, v, [1, 2, 3]) for i, v in enumerate(odd)] + [(None, [1.0, 1.0, 1.0], [0, 0, 0]), (90, [1.0, 0.0, 0.0], None)]
    corpus = spark.createDataFrame(data, "id long, vector array<float>, codes array<int>")
    queries = corpus.where("id % 3 = 0 OR id IS NULL").withColumnRenamed("id", "query_id")
    pairs = search.candidate_pairs(corpus, queries).join(corpus, "id")
    pairs = pairs.join(queries.select("query_id", F.col("vector").alias("asked")), "query_id")
    score = F.round(search.similarity_column(F.col("vector"), F.col("asked"), metric), search.SCORE_DIGITS)
    want = search.top_k(pairs.select("query_id", "id", score.alias("score")), ["query_id"], [F.desc("score"), F.col("id")], 12)
    for size in (search.QUERY_BYTES, 500):
        got = search.approximate_search(corpus, queries, 12, metric, size)
        shown = [sorted(map(str, rows(x, "query_id", "id", "rank", "score"))) for x in (got, want)]
        assert shown[0] == shown[1]
    # No pair of a query and a row is joined.
    plan = search.approximate_search(corpus, queries, 12, metric)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
