"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator; results that the docstrings define."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from meridian.llm import bpe, byte_bpe, byte_dedup, language, media, merkle, mixing, periodic, sharding, simhash, substring_dedup, topk, toxicity
from meridian.sources import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, score string, kept long, repeats string"
LONG = " ".join(f"word{i % 97} übung{i}" for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(40))
ROWS = [
    (1, "alpha beta " + PASSAGE + " gamma", "en", "a", 1, 9, "s", 1, "r"),
    (2, "delta " + PASSAGE + " epsilon zeta", "en", "a", None, None, None, None, None),
    (3, None, None, None, None, 1, "x", 2, "y"),
    (4, "", "de", None, 0, 1, "x", 2, "y"),
    (5, " \t\n ", "de", "b", 4, 1, "x", 2, "y"),
    (6, "same text twice over and over again here", "en", "b", 4, 1, "x", 2, "y"),
    (6, "same text twice over and over again here", "en", "b", 4, 1, "x", 2, "y"),
    (7, "same text twice over and over again here", "en", "b", 4, 1, "x", 2, "y"),
    (None, "alpha beta " + PASSAGE + " gamma", "en", "a", 1, 1, "x", 2, "y"),
    (8, LONG, "de", "c", 1, 1, "x", 2, "y"),
    (9, "x" * 3000, "fr", "c", 1, 1, "x", 2, "y"),
    (10, "123 456 !!! 日本語 🤗", "fr", "c", 1, 1, "x", 2, "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_substring_dedup(docs, empty):
    got = by_id(substring_dedup.remove_repeats(docs, keep=("doc_id", "shard")))
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[2][0]["n_removed"] == 40 and got[2][0]["kept"] == "delta epsilon zeta" and got[2][0]["shard"] is None
    assert got[1][0]["n_removed"] == 0
    assert got[None][0]["n_removed"] == 43  # a null id comes after all others
    assert [r["n_removed"] for r in got[6]] == [0, 0] and got[7][0]["n_removed"] == 0  # under thirteen words
    assert (got[3][0]["n_words"], got[3][0]["kept"], got[4][0]["kept"], got[5][0]["n_words"]) == (0, "", "", 0)
    assert got[8][0]["n_words"] == 40_000
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_byte_dedup(docs, empty):
    got = by_id(byte_dedup.remove_repeated_bytes(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    shared = len(" " + PASSAGE + " ")
    assert got[2][0]["n_removed"] == shared + 2 and got[2][0]["n_spans"] == 1  # two letters before it are the same too
    assert got[None][0]["n_removed"] == got[None][0]["n_bytes"] and got[None][0]["kept"] == b""
    assert got[9][0]["n_removed"] == 0 and got[3][0]["n_bytes"] == 0 and got[8][0]["n_bytes"] == len(LONG.encode())
    assert byte_dedup.remove_repeated_bytes(empty).count() == 0
    texts = byte_dedup.without_repeats(docs)
    assert texts.columns == docs.columns and texts.count() == len(ROWS)
    assert by_id(texts)[2][0]["text"] == "del" + "epsilon zeta" and by_id(texts)[6][0]["kept"] == 2


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    sizes = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = sizes.setdefault(r["source"], [0, r["source_size"], r["target"]])
        s[0] += r["taken"]
    assert all(abs(taken - target) <= 0.5 and target <= 2 * size for taken, size, target in sizes.values())
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == sorted(map(tuple, got), key=str)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.agg(F.sum(mixing.word_count())).first()[0]
    assert words == sum(r["taken"] for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_language(docs, empty):
    learned = language.prototypes(docs)
    assert sorted(learned) == ["de", "en", "fr"]
    got = by_id(language.identify(docs, learned, keep=("doc_id",)))
    assert {i for i, r in got.items() if r[0]["lang_pred"] == "und"} == {3, 4, 5}
    assert all(0 <= r["score"] <= 1 for rows in got.values() for r in rows)
    assert got[8][0]["lang_pred"] == "de" and got[1][0]["lang_pred"] == "en"
    assert language.prototypes(empty) == {}
    assert {r["lang_pred"] for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.identify(empty, learned).count() == 0


def test_topk(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, -0.5]), (0, [1.0, -0.5]), (100, [0.25, 0.25]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [9.0, 9.0]), (7, []), (8, [2.0])]
    vectors = topk.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = [tuple(r) for r in topk.search(vectors, vectors.where("vec_id % 100 = 0"), 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 8, 2048 * 1024), (0, 2, 1, 1024 * 1024), (0, 3, 2, 1024 * 1024), (100, 1, 8, 2048 * 256), (100, 2, 1, 1024 * 256), (100, 3, 2, 1024 * 256)]
    assert topk.search(vectors.where("vec_id < 0"), vectors.where("vec_id < 0")).count() == 0


def test_media(docs, empty):
    stored = media.with_media(docs, into="kept")
    assert sorted(stored.columns) == sorted(docs.columns)
    got = by_id(media.with_features(stored, "kept"))
    assert by_id(media.stored_and_read(docs, media="kept"))[2] == got[2]
    assert all(r["read"]["error"] is None for rows in got.values() for r in rows)
    assert got[3][0]["read"]["payload_sha256"] == hashlib.sha256(bytes(64)).hexdigest() == got[4][0]["read"]["payload_sha256"]
    assert got[6][0]["kept"] == got[7][0]["kept"]
    assert media.decode_png(got[8][0]["kept"]).tobytes().rstrip(b"\0") == LONG.encode()
    bad = docs.limit(1).select(F.lit(None).cast("binary").alias("m")).unionAll(docs.limit(1).select(F.lit(b"nothing").alias("m")))
    assert {r["read"]["error"] for r in media.with_features(bad, "m").collect()} == {None, "not a PNG"}
    assert media.with_media(empty).count() == 0


def test_simhash(docs, empty):
    got = by_id(simhash.near_duplicate_groups(docs))
    assert sum(map(len, got.values())) == len(ROWS)
    assert {got[i][0]["component_id"] for i in (6, 7)} == {6} and {got[i][0]["component_id"] for i in (3, 4, 5)} == {3}
    assert got[3][0]["fp"] == 0 and got[None][0]["component_id"] == 1
    assert simhash.near_duplicate_groups(empty).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(by_id(kept), key=str) == sorted([1, 3, 5, 6, 8, 9, 10, None], key=str)  # 2 shares 36 of 42 shingles with 1; 5 is no text equal to 4, and has no shingle
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_near_copies_with_repeated_lines(spark):
    """Sets decide, so a line that one copy repeats does not keep it: of 296 and 300 distinct shingles 296 are shared."""
    body = " ".join(f"body{i}" for i in range(300))
    rows = [(1, body), (2, body + " body295 body296 body297 body298 body299" * 400), (3, " ".join(f"other{i}" for i in range(300)))]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_near_copies_with_equal_sets(spark, monkeypatch):
    """Texts that differ in case and space are one point, and points with one fingerprint are cut into stripes."""
    met, meetings = [], simhash.meetings
    monkeypatch.setattr(simhash, "meetings", lambda points, *rest: met.append(points.count()) or meetings(points, *rest))
    words = [f"word{i}" for i in range(40)]
    rows = [(k, " ".join(w.upper() if k >> i & 1 else w for i, w in enumerate(words)) + " " * (k % 3)) for k in range(200)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r["doc_id"] for r in kept.collect()] == [0] and met[0] == 1
    monkeypatch.setattr(simhash, "MEET", 64)
    spread = meetings(spark.range(400).selectExpr("id as doc_id", "0L as fp", "0L as fp2"), 1).where("anchor = 0")
    assert max(r["count"] for r in spread.groupBy("one", "two").count().collect()) < 128


def test_bpe(docs, empty):
    path = bpe.default_vocabulary()
    got = by_id(bpe.decode(bpe.encode(docs, path), path))
    assert got[3][0]["n_tokens"] == 0 and got[3][0]["decoded"] == "" and got[5][0]["n_tokens"] == 0
    assert got[6][0]["ids"] == got[7][0]["ids"] and len(got[8][0]["ids"]) == 4 * got[8][0]["n_tokens"]
    assert bpe.encode(empty, path).count() == 0


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (99, 1, 1), (6, None, None), (7, 0, 5)], "doc_id long, quality int, toxic int")
    net = toxicity.learn(docs, labels)
    got = by_id(toxicity.score(docs, net, ("doc_id", "score", "kept")))
    assert sum(map(len, got.values())) == len(ROWS) and all(0 <= r["score"] <= 1 for rows in got.values() for r in rows)
    assert got[3][0]["score"] == got[4][0]["score"] == got[5][0]["score"]
    assert toxicity.learn(empty, labels) is None and toxicity.learn(docs, labels.limit(0)) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(empty, net).count() == 0


def test_sharding(docs, empty):
    got = sharding.shard_rows(docs, 5)
    assert sorted(got.columns) == sorted([*docs.columns, "slot"])
    rows = got.collect()
    assert len(rows) == len(ROWS)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and set(slots) == set(range(5))
    assert sorted(map(str, got.drop("shard", "slot").collect())) == sorted(map(str, docs.select(*[c for c in got.columns if c not in ("shard", "slot")]).collect()))
    assert sharding.shard_rows(empty, 5).count() == 0


def test_sharding_of_copies(spark):
    """A third of 150,000 rows are one row, another is so long that each copy is a portion: no bucket holds more than its size, and none is lost."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("the same row")).when(F.col("id") < 60, F.lit("y" * 5000)).otherwise(F.concat(F.lit("row "), F.col("id").cast("string")))
    rows = spark.range(150_000).select(hot.alias("text"), F.when(F.col("id") % 3 == 0, None).otherwise(F.when(F.col("id") < 60, 1.5).otherwise(F.col("id") / 7)).alias("x"))
    deal = lambda size: sharding.shard_rows(rows, 7, bucket_bytes=size).cache()
    got = deal(32 << 10)
    count = lambda df: {tuple(r)[:2]: r["count"] for r in df.groupBy("text", "x").count().collect()}
    assert count(got) == count(rows)
    per = {r["shard"]: (r["n"], r["least"], r["most"], r["each"]) for r in got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("least"), F.max("slot").alias("most"), F.countDistinct("slot").alias("each")).collect()}
    assert set(per) == set(range(7)) and all(n == each == most + 1 and least == 0 for n, least, most, each in per.values())
    assert max(p[0] for p in per.values()) - min(p[0] for p in per.values()) <= 1
    # Copies lie everywhere: each of 50 stretches of the global order has about a third of them.
    spread = got.groupBy(((F.col("slot") * 7 + F.col("shard")) / 3000).cast("int").alias("part")).agg(F.avg((F.col("text") == "the same row").cast("int")).alias("share")).collect()
    assert len(spread) == 50 and all(0.1 < r["share"] < 0.6 for r in spread)
    again = sharding.shard_rows(rows.repartition(5), 7, bucket_bytes=32 << 10)
    assert again.exceptAll(got).isEmpty()
    parts = sharding._portions(rows.select(F.struct("text", "x").alias("__row"), F.lit(140).cast("long").alias("__bytes"), F.xxhash64("text", "x").alias("__h")), 4096)
    assert parts.agg(F.max("__n"), F.sum("__n")).first()[:] == (29, 150_000)


def test_scratch_is_cleaned(spark, docs):
    scratch.clean(spark)
    components = simhash.components(simhash.materialise(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"), "pairs"))
    assert components.count() == 2
    assert scratch.clean(spark) > 1 and scratch.clean(spark) == 0


def test_manifest(docs, empty):
    """Nulls, equal rows, a null order and a null group; clashing names are replaced."""
    df = docs.withColumns({"root": F.lit(1), "left": F.lit(2)})
    digest = merkle.digest(*[F.col(c) for c in merkle.FIELDS])
    got = merkle.manifest(df, digest, keep=("doc_id", "source", "root", "shard"), span=1).withColumn("folded", merkle.folded(F.col("leaf"))).collect()
    assert len(got) == len(ROWS) and len({r["root"] for r in got}) == 1 and all(r["folded"] == r["root"] for r in got)
    assert {r["source"] for r in got} == {"a", "b", "c", None} and len({(r["source"], r["subroot"]) for r in got}) == 4
    twice = [r for r in got if r["doc_id"] == 6]
    assert len(twice) == 2 and twice[0]["leaf"] == twice[1]["leaf"]
    assert [r["leaf"] for r in got if r["doc_id"] == 3] == [hashlib.sha256(b"1:3----").hexdigest()]
    assert merkle.manifest(empty, digest).count() == 0


def test_periodic(docs, empty, spark):
    got = by_id(periodic.collapse_runs(docs.withColumn("runs", F.lit(1))))
    assert sum(map(len, got.values())) == len(ROWS)
    assert [(got[k][0]["n_words"], got[k][0]["runs"], got[k][0]["collapsed"]) for k in (3, 4, 5)] == [(0, [], "")] * 3
    assert got[8][0]["n_words"] == 40_000 and got[8][0]["runs"] == [] and got[8][0]["collapsed"] == LONG and got[8][0]["shard"] == 1
    texts = [(1, "x " * 50_000), (2, "a b " * 4 + "a c"), (3, "a b a b a b a"), (4, "é\tя\n" * 6), (None, "q q q q q q")]
    got = by_id(periodic.collapse_runs(spark.createDataFrame(texts, "doc_id long, text string")))
    runs = {k: ([tuple(x) for x in r[0]["runs"]], r[0]["collapsed"]) for k, r in got.items()}
    assert runs == {1: ([(0, 50_000, 1)], "x"), 2: ([(0, 9, 2)], "a b c"), 3: ([], "a b a b a b a"), 4: ([(0, 12, 2)], "é я"), None: ([(0, 6, 1)], "q")}
    assert periodic.collapse_runs(empty).count() == 0
    assert periodic.planted(docs).count() == len(ROWS)


def test_byte_bpe(docs, empty):
    path, pattern = byte_bpe.default_vocabulary(), byte_bpe.default_pattern()
    df = docs.withColumn("ids", F.lit("mine"))
    got = by_id(byte_bpe.round_trip(df, path, pattern, keep=("doc_id", "ids", "shard")))
    assert sum(map(len, got.values())) == len(ROWS)
    assert [(got[k][0]["n_tokens"], got[k][0]["ids"], got[k][0]["decoded"]) for k in (3, 4)] == [(0, [], b"")] * 2
    for i, text, *_ in ROWS:
        assert all(bytes(r["decoded"]) == (text or "").encode() and len(r["ids"]) == r["n_tokens"] for r in got[i])
    two = byte_bpe.decode(byte_bpe.encode(df, path, pattern), path, pattern)
    assert {bytes(r["decoded"]) for r in two.collect()} == {(text or "").encode() for _, text, *_ in ROWS}
    assert byte_bpe.round_trip(empty, path, pattern).count() == 0
