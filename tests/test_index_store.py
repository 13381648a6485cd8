"""The stored index against searches over plain texts, over insertions, changes and deletions."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casewright.functions.text import tokens
from casewright.operators import index_store, search
from casewright.streaming import jobs


def stored_columns(df):
    counted = df.withColumn("words", index_store.term_counts(F.col("text")))
    length = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + w.tf)
    return counted.select("id", "text_hash", "words", length.alias("length"))


def put(spark, root, number, rows, kind="long"):
    """A whole snapshot of the source goes to the index: changes, then deletions."""
    folder = f"{root}/source-{number}"
    df = spark.createDataFrame(rows, f"id {kind}, text string")
    df.write.mode("overwrite").parquet(folder)
    docs = jobs.read_stream(spark, folder, f"id {kind}, text string")
    index_store.sync(docs, root, f"{root}/checkpoint-{number}", stored_columns)
    live = index_store.known_hashes(spark, root)
    jobs.delete_missing(df, f"{root}/{index_store.LOG}", live)
    return df


def found(hits):
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in hits.collect())


def texts(rng, n, first=0):
    """A common word in every text, some words in many, one word each in a few."""
    out = []
    for i in range(first, first + n):
        words = ["the"] * rng.randint(1, 9) + [f"m{rng.randint(0, 9)}" for _ in range(rng.randint(0, 30))]
        words += [f"r{rng.randint(0, n)}" for _ in range(rng.randint(0, 6))]
        rng.shuffle(words)
        out.append((i, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def lived(spark, tmp_path_factory):
    """An index after three rounds, with what the source looked like at their ends."""
    root = str(tmp_path_factory.mktemp("index"))
    rng = random.Random(8)
    first = texts(rng, 300) + [(900, None), (901, ""), (902, "lone")]
    second = [r for r in first if r[0] % 4] + texts(rng, 40, 1000)
    third = [(i, f"{t} the m1" if i in (5, 7, 1003) else t) for i, t in second]
    states = []
    for number, rows in enumerate((first, second, third)):
        df = put(spark, root, number, rows)
        states.append((index_store.compact(spark, root, buckets=8), df))
    return root, states


def test_rows_follow_the_source(spark, lived):
    _, states = lived
    for snapshot, df in states[-1:]:
        got = {r.id: (r.length, {w.term: w.tf for w in r.words}) for r in index_store.live_rows(spark, snapshot).collect()}
        want = {}
        for r in df.collect():
            words = re.findall("[a-z0-9]+", (r.text or "").lower())
            want[r.id] = (len(words), {w: words.count(w) for w in words})
        assert got == want
        assert snapshot.rows == len(want)
        assert snapshot.tokens == sum(n for n, _ in want.values())


@pytest.mark.parametrize("k", [1, 3, 50])
def test_keyword_search_equals_a_search_of_all_texts(spark, lived, monkeypatch, k):
    monkeypatch.setattr(index_store, "BLOCK", 4)
    _, states = lived
    snapshot, df = states[-1]
    asked = ["the", "m1 m2 m3", "r5 the", "r1 r2 r3 r4 r77 the m5", "lone the", "nowhere", "", None, "The THE m0 m0"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, text string")
    expected = found(search.keyword_search(df, queries, k))
    assert found(index_store.keyword_search(spark, snapshot, queries, k)) == expected
    # Blocks of few queries give the same.
    assert found(index_store.keyword_search(spark, snapshot, queries, k, query_bytes=1)) == expected


def test_older_snapshots_stay_readable(spark, lived):
    _, states = lived
    snapshot, df = states[0]
    queries = spark.createDataFrame([(1, "the m1 r5")], "query_id int, text string")
    assert found(index_store.keyword_search(spark, snapshot, queries, 5)) == found(
        search.keyword_search(df, queries, 5)
    )


def test_compaction_rewrites_touched_buckets_only(spark, lived):
    root, states = lived
    before, after = states[1][0], states[2][0]
    touched = {b for b, p in after.parts.items() if p[0] == after.number}
    changed = spark.createDataFrame([(5,), (7,), (1003,)], "id long")
    buckets = changed.select(index_store.bucket_of(F.col("id"), 8).alias("b")).collect()
    assert touched == {r.b for r in buckets}
    assert all(after.parts[b] == before.parts[b] for b in before.parts if b not in touched)
    # Nothing new in the log: nothing is written.
    assert index_store.compact(spark, root) == after


def test_searches_read_no_text_and_aggregate_no_ids(spark, lived):
    _, states = lived
    rows = index_store.live_rows(spark, states[-1][0])
    assert "Aggregate" not in rows._jdf.queryExecution().executedPlan().toString()
    queries = spark.createDataFrame([(1, "the m1 r5")], "query_id int, text string")
    plan = index_store.keyword_search(spark, states[-1][0], queries, 5)._jdf.queryExecution().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert scans and all("postings" in x and "text" not in x.split("ReadSchema")[1].replace("texts", "") for x in scans)
    assert all("In(term" in x for x in scans)


def test_blocks_that_cannot_matter_are_left_out(spark, tmp_path):
    """A common word's blocks are read where the rare word is, and not elsewhere."""
    rows = [(i, "the " * (1 + i % 3) + "x " * 20) for i in range(2000)] + [(5000 + i, "rare the") for i in range(3)]
    root = str(tmp_path)
    put(spark, root, 0, rows)
    snapshot = index_store.compact(spark, root, buckets=64)
    postings = index_store._read(spark, snapshot, index_store.POSTINGS)
    norm = index_store._Norm(0.3, 0.9 * snapshot.rows / snapshot.tokens)
    met = postings.where("term IN ('rare', 'the')").withColumn("bound", norm.column("most", "shortest"))
    floors = {r.term: r.floor for r in index_store.term_statistics(met, norm, 3).collect()}
    weight = {"rare": 10.0, "the": 0.01}
    needed = index_store.needed_bounds(spark, met, [(1, ["rare", "the"])], weight, [10.0 * floors["rare"]])
    kept = met.join(needed, ["term", "bucket"]).where("bound >= needed - 1e-9")
    with_rare = postings.where("term = 'rare'").select("bucket").distinct().count()
    assert kept.select("bucket").distinct().count() == with_rare < 4
    assert met.select("bucket").distinct().count() > 50


def test_deletions(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, 0, [("a", "x"), ("b", "y y"), ("c", None)], "string")
    first = index_store.compact(spark, root)
    assert {r.id for r in index_store.live_rows(spark, first).collect()} == {"a", "b", "c"}
    df = put(spark, root, 1, [("a", "x")], "string")
    # Before the compaction, the log alone says so.
    assert {r.id for r in jobs.current_index(spark, f"{root}/log").collect()} == {"a"}
    assert {r.id for r in index_store.known_hashes(spark, root).collect()} == {"a"}
    second = index_store.compact(spark, root)
    # A second call finds nothing to delete, and a deleted id may come back with its old text.
    assert jobs.delete_missing(df, f"{root}/log", index_store.live_rows(spark, second)) == -1
    put(spark, root, 2, [("b", "y y")], "string")
    third = index_store.compact(spark, root)
    assert [(r.id, r.length) for r in index_store.live_rows(spark, third).collect()] == [("b", 2)]
    put(spark, root, 3, [], "string")
    fourth = index_store.compact(spark, root)
    assert fourth.rows == 0 and index_store.live_rows(spark, fourth).count() == 0
    queries = spark.createDataFrame([(1, "y")], "query_id int, text string")
    assert index_store.keyword_search(spark, fourth, queries, 5).count() == 0


def test_an_interrupted_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, root, 0, [("a", "x")], "string")
    first = index_store.compact(spark, root)
    put(spark, root, 1, [("a", "x z"), ("d", "w")], "string")

    def broken(rows):
        raise RuntimeError("lost")

    monkeypatch.setattr(index_store, "blocks_of", broken)
    with pytest.raises(RuntimeError):
        index_store.compact(spark, root)
    assert index_store.open_store(spark, root) == first
    monkeypatch.undo()
    again = index_store.compact(spark, root)
    assert {r.id: r.length for r in index_store.live_rows(spark, again).collect()} == {"a": 2, "d": 1}


def test_a_repeated_step_loses_nothing(spark, tmp_path):
    """A step that is tried again writes what it wrote before, not what is new since itself."""
    root = str(tmp_path)
    one = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string")
    two = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "w")], "id string, text string")
    for rows, run in ((one, 1), (one, 1), (two, 2), (two, 2)):
        index_store.sync_rows(rows, root, jobs.Step("runs", run), index_store.text_columns)
    log = spark.read.parquet(f"{root}/log")
    assert sorted((r.id, r.version) for r in log.collect()) == [("a", 0), ("b", 0), ("b", 1), ("c", 1)]
    snapshot = index_store.compact(spark, root)
    assert {r.id for r in index_store.live_rows(spark, snapshot).collect()} == {"a", "b", "c"}


def test_a_compaction_moves_words_once_and_makes_blocks_where_rows_are(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "BUCKET_ROWS", 10)
    monkeypatch.setattr(index_store, "HELD", 50)
    monkeypatch.setattr(index_store, "LISTED_WORDS", 3)
    monkeypatch.setattr(index_store, "BLOCK", 4)
    root = str(tmp_path)
    rows = texts(random.Random(3), 300) + [(900, None), (901, ""), (902, "a b c d e f g h i a")]
    df = put(spark, root, 0, rows)
    snapshot = index_store.compact(spark, root)
    # The number of buckets follows the rows.
    assert snapshot.buckets == 31
    live = index_store.live_rows(spark, snapshot)
    assert "Exchange" not in index_store.blocks_of(live)._jdf.queryExecution().executedPlan().toString()
    got = index_store._read(spark, snapshot, index_store.POSTINGS).select("term", "bucket", "texts", F.inline("postings"))
    postings = sorted((r.term, r.id, r.tf, r.length) for r in got.collect())
    lengths = {r.id: re.findall("[a-z0-9]+", (r.text or "").lower()) for r in df.collect()}
    assert postings == sorted((w, i, ws.count(w), len(ws)) for i, ws in lengths.items() for w in set(ws))
    queries = spark.createDataFrame([(1, "the m1 r5"), (2, "i a")], "query_id int, text string")
    assert found(index_store.keyword_search(spark, snapshot, queries, 5)) == found(search.keyword_search(df, queries, 5))


@pytest.mark.parametrize("few", [0, 100])
def test_newest_rows_move_repeated_ids_alone(spark, monkeypatch, few):
    monkeypatch.setattr(jobs, "FEW_IDS", few)
    once = spark.createDataFrame([(i, f"t{i}", i, 0) for i in range(9)], "id long, text string, text_hash long, version long")
    moved = [x for x in jobs.newest_versions(once)._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x]
    assert not moved
    more = once.unionByName(once.where("id < 3").withColumns({"version": F.lit(7).cast("long"), "text": F.lit("new")}))
    more = more.unionByName(spark.createDataFrame([(None, "n", 1, v) for v in (1, 4)], more.schema))
    got = sorted(((r.id, r.text, r.version) for r in jobs.newest_versions(more).collect()), key=str)
    want = [(i, "new", 7) if i < 3 else (i, f"t{i}", 0) for i in range(9)] + [(None, "n", 4)]
    assert got == sorted(want, key=str)
    kept = jobs.without_ids(more.select("id"), spark.createDataFrame([(1,), (None,)], "id long"))
    assert sorted((r.id for r in kept.collect()), key=str) == sorted([0, 0, 2, 2, *range(3, 9), None, None], key=str)


def test_term_counts_of_plain_and_other_texts(spark):
    """Texts cut where they are counted have the tokens that the others have."""
    texts = ["Hello, hello w0rld_x", None, "", "abc", "def GHI abc", "Ünïcode straße A1 İ K", "  ..  ", "x", "É", "a-b\x00c"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    got = df.select("id", index_store.term_counts(F.col("text")).alias("w"), tokens(F.col("text")).alias("t")).collect()
    for r in got:
        assert sorted((w.term, w.tf) for w in r.w) == sorted(Counter(r.t or []).items())


def test_plain_texts_cross_to_python_without_their_tokens(spark):
    """Only texts with other characters are cut in the JVM, and no list is null, which Arrow is slow to write."""
    plan = spark.createDataFrame([("a b",)], "text string").select(index_store.term_counts(F.col("text")))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in text and "ELSE []" in text
