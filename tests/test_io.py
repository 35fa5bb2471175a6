import json
import os
from dataclasses import dataclass
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rookery.operators.ranking import recommend, score_articles, update_seen
from rookery.plans.recommend import SocialTables, read_stored, refresh, store_refresh
from rookery.sources import articles as corpus, sinks, tables
from rookery.sources.bucketed import lookup_bucketed, store_bucketed
from rookery.sources.chunked import FolderStore, write_chunked
from rookery.sources.versions import KeyedLog, VersionedTables
from rookery.streaming import tables as streams
from rookery.streaming.refresh import refresh_on_changes

CORPUS = [
    dict(category="CRIME", headline="One", authors="Ann", link="l1", short_description="d1", date="2017-11-30"),
    dict(category="WEIRD NEWS", headline="Two", authors="A\nB", link="l2", short_description="d2", date="2016-02-29"),
    dict(category="MONEY", headline="Two", authors="", link="l2", short_description="d3", date="2017-11-30"),
    dict(category="MONEY", headline="No link", authors="", short_description="d", date="2017-11-30"),
    dict(category="MONEY", headline="Bad date", authors="", link="l3", short_description="d", date="soon"),
]


@pytest.fixture
def corpus_path(tmp_path):
    path = tmp_path / "corpus.json"
    path.write_text("\n".join(json.dumps(row) for row in CORPUS) + "\nnot json\n")
    return str(path)


def test_article_scan(spark, corpus_path):
    scanned = corpus.read_articles(spark, corpus_path)
    usable = {(r.link, r.author): r.date for r in corpus.usable_articles(scanned).collect()}
    assert usable == {("l1", "Ann"): date(2021, 11, 30), ("l2", "A\nB"): date(2020, 2, 29), ("l2", ""): date(2021, 11, 30)}
    assert corpus.rejected_articles(scanned).count() == 3


def test_catalogue_and_dates(spark, corpus_path, rows):
    usable = corpus.usable_articles(corpus.read_articles(spark, corpus_path))
    catalog = sinks.build_article_catalog(usable)
    assert rows(catalog, "link", "likes", "category") == [("l1", 0, "CRIME"), ("l2", 0, "MONEY")]
    assert corpus.published_by(usable, date(2020, 2, 29)).count() == 1
    assert corpus.published_on(usable, date(2021, 11, 30)).count() == 2


def test_stopwords(spark, tmp_path, rows):
    (tmp_path / "stop.txt").write_bytes(b"a\r\nabout\r\naren't")
    assert {w for (w,) in rows(corpus.read_stopwords(spark, str(tmp_path / "stop.txt")))} == {"a", "about", "aren't"}


def test_user_and_friend_tables(spark, tmp_path, rows):
    spark.createDataFrame(
        [("u", ["A", "none", "A"], None, ["none"]), ("v", None, ["l1"], [])],
        "username string, interests array<string>, likednewsarticles array<string>, seenarticles array<string>",
    ).write.parquet(str(tmp_path / "users"))
    users = tables.read_users(spark, str(tmp_path / "users"))
    assert rows(users, "interests", "likednewsarticles", "seenarticles") == [(["A"], [], []), ([], ["l1"], [])]
    assert rows(tables.explode_set(users, "interests", "category")) == [("u", "A")]
    spark.createDataFrame([("u", "1705", "v")], "username1 string, timestamp string, username2 string").write.parquet(str(tmp_path / "friends"))
    assert rows(tables.read_friends(spark, str(tmp_path / "friends"))) == [("u", 1705, "v")]
    keys = spark.createDataFrame([("v",)], "username string")
    assert rows(tables.lookup(users, "username", keys), "username") == [("v",)]


def test_snapshot_keeps_the_last_write(spark, tmp_path, rows):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("m", 1, "x")], "key string, ts int, value string")
    path = str(tmp_path / "snap")
    sinks.write_snapshot(frame, path, ["key"], order=F.col("ts"))
    sinks.write_snapshot(frame.where("key = 'k'"), path, ["key"], order=F.col("ts"))
    assert rows(spark.read.parquet(path)) == [("k", 2, "new")]


def test_batched_sink_retries_what_is_refused(spark, tmp_path):
    folder = str(tmp_path)

    def sink(chunk):
        import os
        import uuid

        assert len(chunk) <= 4
        with open(os.path.join(folder, uuid.uuid4().hex + ".txt"), "w") as out:
            out.write("\n".join(r.key for r in chunk[:3]))
        return chunk[3:]

    frame = spark.createDataFrame([(f"k{i}", i) for i in range(30)] + [("k0", 99)], "key string, n int")
    sinks.write_batched(frame, ["key"], sink, batch=4)
    delivered = [w for f in tmp_path.glob("*.txt") for w in f.read_text().split()]
    assert sorted(delivered) == sorted(f"k{i}" for i in range(30))


def test_batched_sink_gives_up(spark):
    frame = spark.createDataFrame([("k",)], "key string")
    with pytest.raises(Exception, match="still refused"):
        sinks.write_batched(frame, ["key"], lambda chunk: chunk, retries=1)


def test_scores_and_recommendations(spark, rows):
    labels = spark.createDataFrame(
        [("article", "l1", "u", 0.9), ("article", "l1", "v", 0.01), ("article", "l2", "u", 1.0), ("user", "l1", "u", 0.9), ("article", "ghost", "u", 0.5)],
        "node_type string, node string, label string, weight double",
    )
    day, later = date(2024, 1, 15), date(2024, 1, 16)
    articles = spark.createDataFrame(
        [("me", "B", day, "h", "l1", "d"), ("me", "A", day, "h", "l1", "d"), ("me", "A", later, "h", "l2", "d")],
        "author string, category string, date date, headline string, link string, description string",
    )
    scores = score_articles(labels, articles, day)
    assert rows(scores, "username", "link", "category", "weight") == [("u", "l1", "A", 0.9)]
    everything = score_articles(labels, articles, None, 0.0)
    assert everything.count() == 3
    seen = spark.createDataFrame([("u", "l2")], "username string, link string")
    certain = everything.withColumn("weight", everything.weight * 0 + 1.0)
    recs = recommend(certain, seen, day)
    assert rows(recs, "username", "link") == [("u", "l1"), ("v", "l1")]
    assert recommend(certain.withColumn("weight", certain.weight * 0 - 1.0), seen, day).count() == 0
    assert rows(update_seen(seen, recs)) == [("u", "l1"), ("u", "l2"), ("v", "l1")]


def small_network(spark, day):
    return SocialTables(
        users=spark.createDataFrame([("u",), ("v",)], "username string"),
        interests=spark.createDataFrame([("u", "A")], "username string, category string"),
        likes=spark.createDataFrame([("u", "l1"), ("v", "l1")], "username string, link string"),
        seen=spark.createDataFrame([("v", "l1")], "username string, link string"),
        friends=spark.createDataFrame([("u", "v"), ("v", "u")], "username1 string, username2 string"),
        articles=spark.createDataFrame(
            [("me", "A", day, "h", "l1", "d")], "author string, category string, date date, headline string, link string, description string"
        ),
    )


def check_stored(spark, folder, rows):
    assert {r.username for r in read_stored(spark, folder, "scores").collect()} == {"u", "v"}
    assert {r.username for r in read_stored(spark, folder, "recommendations").collect()} <= {"u"}
    assert ("v", "l1") in rows(read_stored(spark, folder, "seen"), "username", "link")


def test_refresh_stores_its_tables(spark, tmp_path, rows):
    day = date(2024, 1, 15)
    network, folder = small_network(spark, day), str(tmp_path)
    store_refresh(refresh(network, day, max_iter=2), folder)
    check_stored(spark, folder, rows)
    # the next refresh reads the seen table that it replaces
    network.seen = read_stored(spark, folder, "seen")
    store_refresh(refresh(network, day, max_iter=2), folder)
    check_stored(spark, folder, rows)


def test_interest_changes_start_a_refresh(spark, tmp_path, rows):
    day = date(2024, 1, 15)
    source, out, offsets = (str(tmp_path / n) for n in ("changes", "out", "offsets"))
    changed = spark.createDataFrame([("u", "A")], "username string, category string")
    changed.coalesce(1).write.parquet(source)
    stream = streams.file_stream(spark, source, changed.schema)
    query = refresh_on_changes(stream, lambda: small_network(spark, day), lambda: day, out, offsets)
    query.awaitTermination()
    check_stored(spark, out, rows)


def test_streams_take_files_as_they_arrive(spark, tmp_path, rows):
    """Two runs over a growing folder end where the batch operator does."""
    schema = "username string, loggedin boolean, timestamp bigint, seq bigint"
    first = spark.createDataFrame([("u", True, 1, 0), ("v", True, 1, 1)], schema)
    second = spark.createDataFrame([("u", False, 2, 2)], schema)
    folder, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))

    def run():
        stream = streams.stream_presence(streams.file_stream(spark, folder, first.schema))
        log = KeyedLog(spark, out, stream.schema, ["username"])
        query = (
            stream.writeStream.outputMode("update")
            .foreachBatch(log.write)
            .option("checkpointLocation", offsets)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return rows(log.read())

    first.coalesce(1).write.parquet(folder)
    assert run() == [("u", True), ("v", True)]
    second.coalesce(1).write.mode("append").parquet(folder)
    assert run() == [("u", False), ("v", True)]


def test_a_crash_between_tables_leaves_the_old_set(spark, tmp_path, rows, monkeypatch):
    day, folder = date(2024, 1, 15), str(tmp_path)
    network = small_network(spark, day)
    store_refresh(refresh(network, day, max_iter=2), folder)
    before = {t: rows(read_stored(spark, folder, t)) for t in ("scores", "recommendations", "seen")}
    network.likes = network.likes.where("username = 'u'")
    second = refresh(network, day, max_iter=2)
    from rookery.plans import recommend

    real, calls = recommend.write_snapshot, []

    def failing(*args, **kwargs):
        calls.append(args[1])
        if len(calls) == 2:
            raise OSError("lost")
        real(*args, **kwargs)

    monkeypatch.setattr(recommend, "write_snapshot", failing)
    with pytest.raises(OSError):
        store_refresh(second, folder)
    assert {t: rows(read_stored(spark, folder, t)) for t in before} == before
    monkeypatch.setattr(recommend, "write_snapshot", real)
    store_refresh(second, folder)
    assert rows(read_stored(spark, folder, "scores")) != before["scores"]


def test_versions_take_turns(spark, tmp_path, rows):
    store = VersionedTables(spark, str(tmp_path))
    assert store.current() == 0
    for version in range(1, 6):
        spark.range(version).write.parquet(store.path("t", version))
        store.publish(version, ["t"])
        assert store.current() == version and store.read("t").count() == version
    assert spark.read.parquet(store.path("t", 4)).count() == 4  # the one before is still there
    assert spark.read.parquet(store.path("t", 3)).count() == 0
    # a crash while a manifest is overwritten leaves the other one
    spark.range(0).selectExpr("id AS version").write.mode("overwrite").parquet(f"{tmp_path}/_manifest_1")
    assert store.current() == 4


def test_keyed_log_of_many_batches(spark, tmp_path, rows):
    schema = "k string, v int"
    state, log = {}, KeyedLog(spark, str(tmp_path), spark.createDataFrame([], schema).schema, ["k"], every=7)
    for n in range(50):
        batch = {f"k{n % 9}": n, "hot": n, f"only{n}": n}
        state.update(batch)
        frame = spark.createDataFrame(list(batch.items()), schema)
        log.write(frame, n)
        if n in (13, 20, 33):  # repeated after a failure, also right after a snapshot
            log.write(frame, n)
        changes = [d for root in tmp_path.glob("changes_*") for d in os.listdir(root) if d.startswith("batch_id=")]
        assert len(changes) < 7
    assert dict(rows(log.read())) == state


@dataclass
class Refusing(FolderStore):
    """Never takes the row with key k7."""

    def stage(self, attempt, number, rows):
        staged, refused = super().stage(attempt, number, [r for r in rows if r.key != "k7"])
        return staged, refused + [r for r in rows if r.key == "k7"]


def test_chunked_writer_commits_all_or_nothing(spark, tmp_path, rows):
    frame = spark.createDataFrame([(f"k{i}", i) for i in range(60)] + [("k0", 99)], "key string, n int").repartition(3)
    store = FolderStore(f"file://{tmp_path}/a", capacity=4)
    write_chunked(frame, ["key"], store, chunk=10)
    got = rows(spark.read.parquet(f"{tmp_path}/a/rows"))
    assert got == sorted([(f"k{i}", i) for i in range(1, 60)] + [("k0", 99)], key=str)
    assert max(spark.read.parquet(str(p)).count() for p in (tmp_path / "a/rows").glob("*.parquet")) <= 4
    with pytest.raises(Exception, match="still refused"):
        write_chunked(frame, ["key"], Refusing(f"file://{tmp_path}/b"), chunk=10, retries=1)
    assert not (tmp_path / "b/rows").exists()


def test_bucketed_lookup_shuffles_the_keys_only(spark, tmp_path, rows):
    users = spark.createDataFrame([(f"u{i}", i) for i in range(100)], "username string, n int")
    table = store_bucketed(users, str(tmp_path / "buckets"), ["username"], 4)
    keys = spark.createDataFrame([("u7",), ("u7",), ("u9",), ("ghost",)], "username string")
    found = lookup_bucketed(spark, table, keys)
    assert rows(found) == [("u7", 7), ("u9", 9)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the left side of the join is drawn behind colons
    stored = [line for line in plan.splitlines() if line.lstrip().startswith(":")]
    assert any("Bucketed: true" in line for line in stored), plan
    assert not any("Exchange" in line for line in stored), plan
    spark.sql(f"DROP TABLE {table}")


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    rows_ = spark.range(20000).select((F.col("id") % 7000).cast("string").alias("k"), "id")
    spark.conf.set(size, "16k")
    try:
        name = store_bucketed(rows_, str(tmp_path / "large"), ["k"], 2)
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "large").glob("*.parquet"))) > 2
    stored = spark.table(name)
    assert stored.count() == 20000 and stored.exceptAll(rows_).isEmpty()


def test_stored_scores_leave_no_tables_of_the_propagation(spark, tmp_path):
    import __spark_entry__ as entry
    from rookery.plans.scratch import scratch_root
    from rookery.sources.sample_tables import SampleTables

    def tables():
        return {p for p in Path(scratch_root(spark)).glob("adsorption-*/*/") if p.is_dir()}

    kinds = F.element_at(F.array(*map(F.lit, ("signup", "purchase", "view", "click"))), (F.col("id") % 4 + 1).cast("int"))
    events = spark.range(80).select(
        F.col("id").alias("event_id"), (F.col("id") * 7 % 5).alias("user_id"), kinds.alias("event_type"),
        F.format_string('{"k": %d}', F.col("id") % 9).alias("props"), F.timestamp_seconds(F.col("id") + 1700000000).alias("ts"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    spark.range(12).select(
        F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.lit("en").alias("lang"),
        F.concat(F.lit("src"), F.col("id") % 3).alias("source"),
    ).write.parquet(str(tmp_path / "documents.parquet"))
    before = tables()
    t = SampleTables(spark, str(tmp_path))
    scores = entry.QUERIES["article_scores_unfiltered"](t)
    assert scores.count() > 0 and not tables() - before
