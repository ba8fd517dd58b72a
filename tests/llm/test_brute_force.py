"""Queries that SQL can't state, or only slowly, against brute force over the small tables."""

import hashlib
import itertools
import math
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from meridian.llm import bpe, byte_bpe, byte_dedup, language, media, merkle, periodic, queries, sharding, simhash, substring_dedup, suffix_array, topk, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, n):
    words = WORDS.findall((text or "").encode().translate(LOWER))
    return [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


@needs_tables
def test_registered():
    assert [re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES] and len(queries.QUERIES) == 13
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))


@needs_tables
@pytest.mark.parametrize("hot", [1 << 18, 1])
def test_byte_dedup(docs, hot):
    """Both ways of anchors: the common one, and that of anchors with many pieces."""
    rows = sorted((r["doc_id"], (r["text"] or "").encode()) for r in docs.collect())
    first = {}
    for i, b in rows:
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    want = {}
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        want[i] = (len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone]))
    found = byte_dedup.remove_repeated_bytes(docs, hot_bytes=hot, batch_bytes=1 << 16, shard_bytes=1 << 14).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found} == want


def test_suffix_arrays():
    rng = np.random.default_rng(5)
    for n, k in itertools.product((1, 2, 3, 7, 40, 300), (1, 2, 4, 26, 3000)):
        s = rng.integers(0, k, n)
        if n == 300:
            s = np.tile(s[:60], 5)
        want = sorted(range(n), key=lambda i: s[i:].tolist())
        order = suffix_array.suffix_array(s)
        assert order.tolist() == want
        lcp = suffix_array.permuted_lcp(s, order, n + 1)
        for a, b in itertools.pairwise(want):
            common = next((j for j in range(n) if max(a, b) + j >= n or s[a + j] != s[b + j]), n)
            assert lcp[b] == common


def test_suffix_arrays_of_long_strings():
    """Strings of 100 kB with names of LMS substrings that repeat over several levels: random, periodic, copied and Fibonacci strings."""
    rng = np.random.default_rng(8)
    copied = rng.integers(97, 123, 5000)
    a, b = "a", "ab"
    while len(b) < 100_000:
        a, b = b, b + a
    phrases = [rng.integers(97, 123, k) for k in rng.integers(3, 60, 40)]
    made = [rng.integers(0, 4, 100_000), np.tile(rng.integers(0, 9, 37), 3000), np.concatenate([copied] * 20), np.frombuffer(b.encode(), np.uint8), np.concatenate([phrases[i] for i in rng.integers(0, 40, 3000)])]
    levels, inner = [], suffix_array._induce
    for s in made:
        order = suffix_array.suffix_array(s)
        rank = np.empty(len(s) + 1, np.int64)
        rank[order], rank[len(s)] = np.arange(len(s)), -1
        # Each suffix is larger than the one before it: by its first sign, or by the suffix after that.
        key = s[order].astype(np.int64) * (len(s) + 1) + rank[order + 1]
        assert (np.diff(key) > 0).all() and len(np.unique(order)) == len(s)
    calls = levels.append
    suffix_array._induce = lambda s, *rest: calls(len(s)) or inner(s, *rest)
    try:
        suffix_array.suffix_array(made[3])
    finally:
        suffix_array._induce = inner
    assert len(set(levels)) > 5  # the names are sorted by the same steps, level by level


def test_words_with_equal_polynomials(spark):
    """Two words of 1,024 letters that polynomials modulo 2**64 can't tell apart, whatever the multiplier, are different words."""
    bits = [i.bit_count() & 1 for i in range(1024)]
    one, two = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))
    rows = [(k, " ".join([f"w{i}" for i in range(12)] + [t])) for k, t in enumerate((one, two, one))]
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 13}


@needs_tables
@pytest.mark.parametrize(("blocks", "meet"), [(1, 4096), (2, 4096), (1, 8)])
def test_simhash(docs, blocks, meet, monkeypatch):
    """One block of bits and two, and anchors so crowded that they are cut into stripes."""
    monkeypatch.setattr(simhash, "MEET", meet)
    prints = {}
    for r in docs.collect():
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles(r["text"], 4)]
        prints[r["doc_id"]] = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
    groups = Groups(prints)
    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            groups.join(a, b)
    found = simhash.near_duplicate_groups(docs, blocks=blocks).collect()
    assert {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in found} == {i: (p, groups.find(i)) for i, p in prints.items()}


@needs_tables
def test_near_copies(docs):
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    sets, groups = {i: set(shingles(t, 5)) for i, t in rows.items()}, Groups(rows)
    for a, b in itertools.combinations(rows, 2):
        both = len(sets[a] & sets[b])
        if rows[a] == rows[b] or both and both >= 0.8 * len(sets[a] | sets[b]):
            groups.join(a, b)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).select("doc_id").collect()}
    assert kept == {i for i in rows if groups.find(i) == i}


def test_near_copies_around_the_limit(spark):
    """A family of variants whose similarities lie around 0.8: every pair that meets at an anchor is tested, not only the closest."""
    rng = np.random.default_rng(7)
    body = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(f"new{i}x{k}" if rng.random() < 0.02 else w for k, w in enumerate(body))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {r["doc_id"]: r for r in simhash.fingerprints(docs, 5, wide=True).collect()}
    met = []
    for i in prints:
        lanes = [np.array([prints[i][c] % (1 << 64)], np.uint64) for c in ("fp", "fp2")]
        met.append({(k, a) for k, start in enumerate(simhash.BLOCK_STARTS) for a in simhash.anchors(lanes[start // 64], 1, start % 64)[1].tolist()})
    sets, groups = [set(shingles(t, 5)) for _, t in rows], Groups(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        bits = sum(((prints[a][c] ^ prints[b][c]) % (1 << 64)).bit_count() for c in ("fp", "fp2"))
        if sets[a] == sets[b] or bits <= simhash.CANDIDATE_BITS and met[a] & met[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            groups.join(a, b)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == {i for i in range(len(rows)) if groups.find(i) == i}


@needs_tables
def test_sharding_of_documents(spark, docs, tmp_path):
    """The query's digests are those of the documents that are dealt and written, at their places."""
    want = {r["doc_id"]: (len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()), r["shard"], r["slot"]) for r in sharding.shard_rows(docs, 8).collect()}
    found = sharding.op10_sharding(spark, SF).collect()
    assert len(found) == len(want) and {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found} == want
    sharding.write_shards(docs, f"{tmp_path}/shards", 8)
    written = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert {r["doc_id"]: (len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()), r["shard"], r["slot"]) for r in written} == want


def test_golay_anchors():
    """Each 23-bit word has one anchor within 3 bits, and words 4 bits apart share an anchor within 5 of both."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    at, near = simhash._near(words, 0)
    assert at.tolist() == list(range(500)) and (np.bitwise_count(words ^ near) <= 3).all()
    flips = np.array([sum(1 << int(b) for b in rng.choice(23, rng.integers(0, 5), replace=False)) for _ in words])
    for x, y in zip(words.astype(np.uint64), (words ^ flips).astype(np.uint64), strict=True):
        one, two = (set(simhash.anchors(np.array([v]), 1)[1].tolist()) for v in (x, y))
        assert one & two


def test_topk_lists():
    rng = np.random.default_rng(2)
    x = np.floor(rng.standard_normal((700, 12)) * 50).astype(np.int64)
    x[100:200] = x[:100]
    lists = topk.Lists(x, np.arange(700)[::-1].copy())
    for q, own in [*zip(x[::50], range(0, 700, 50), strict=False), (np.zeros(12, np.int64), -1)]:
        ids, scores = lists.best(q, 10, own)
        every = sorted(((-int(s), int(i)) for i, s in zip(lists.ids, x @ q, strict=True) if i != own))[:10]
        assert [(-int(s), int(i)) for i, s in zip(ids, scores, strict=True)] == every


def test_topk_stops_reading():
    """Where the best rows stand out, a part of the lists settles the search; rows are never looked up, as only lists are kept."""
    rng = np.random.default_rng(4)
    x = np.floor(rng.standard_normal((4000, 4)) * 50).astype(np.int64)
    x[::100] += 2000  # forty rows lead every list
    lists = topk.Lists(x, np.arange(4000))
    assert not hasattr(lists, "x")
    for q in np.abs(x[::400]) + 1:
        before = lists.read
        ids, scores = lists.best(q, 10, -1)
        assert list(zip((-scores).tolist(), ids.tolist(), strict=True)) == sorted(zip((-(x @ q)).tolist(), range(4000), strict=True))[:10]
        assert lists.read - before < x.size / 10
    # On lists that tell nothing all is read.
    flat = topk.Lists(np.tile(np.arange(2000)[:, None], (1, 2)) * [1, -1], np.arange(2000))
    assert flat.best(np.array([1, 1]), 3, -1)[0].tolist() == [0, 1, 2] and flat.read == 4000


def test_topk_of_a_block():
    """Queries that read together have the results that each has alone: zero, one-sided and huge ones, with ties, own rows twice, and fewer rows than k."""
    rng = np.random.default_rng(8)
    for n, most in ((900, 40), (900, 1 << 40), (6, 40)):
        x = rng.integers(-most, most, (n, 5))
        x[n // 2 :] = x[: n - n // 2]
        lists = topk.Lists(x, np.arange(n) // 3 * 3)
        asked = np.concatenate([x[:40], np.abs(x[:5]), np.zeros((1, 5), np.int64)])
        own = np.append(np.arange(len(asked) - 1) * 3, -1)
        for q, i, (ids, scores) in zip(asked, own, lists.best_of(asked, 10, own), strict=True):
            exact = x.astype(object) @ q.astype(object)
            every = sorted((-int(s), int(j)) for j, s in zip(lists.ids, exact, strict=True) if j != i)[:10]
            assert [(-int(s), int(j)) for j, s in zip(ids, scores, strict=True)] == every


def test_topk_beyond_64_bits(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 0.0]), (3, [2.0, 1.0])]
    vectors = topk.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [tuple(r) for r in topk.search(vectors, vectors.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 2**63 - 1), (0, 3, 2, -(2**63))]


def test_png_filters():
    """All five filters, a checksum that fails, and chunks that are cut short."""
    rng = np.random.default_rng(3)
    image = rng.integers(0, 256, (10, 64), dtype=np.uint8).astype(int)
    rows = []
    for y, line in enumerate(image):
        up = image[y - 1] if y else np.zeros(64, int)
        left, corner = np.r_[0, line[:-1]], np.r_[0, up[:-1]]
        p = left + up - corner
        d = np.abs(np.stack([p - left, p - up, p - corner]))
        paeth = np.where((d[0] <= d[1]) & (d[0] <= d[2]), left, np.where(d[1] <= d[2], up, corner))
        kind = y % 5
        rows.append(bytes([kind]) + ((line - (0, left, up, (left + up) // 2, paeth)[kind]) % 256).astype(np.uint8).tobytes())
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    data = zlib.compress(b"".join(rows))
    png = media.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 64, 10, 8, 0, 0, 0, 0)) + chunk(b"tEXt", b"a\0b") + chunk(b"IDAT", data[:50]) + chunk(b"IDAT", data[50:]) + chunk(b"IEND", b"")
    assert (media.decode_png(png) == image).all()
    for bad in (png[:-20], png[:60] + bytes([png[60] ^ 1]) + png[61:], png[:20]):
        with pytest.raises(ValueError):
            media.decode_png(bad)
    for n in (64, 128, 6400, 64_000):
        raw = rng.integers(32, 120, n, dtype=np.uint8).tobytes()
        assert media.decode_png(media.encode_png(raw)).tobytes() == raw


@needs_tables
def test_media_query(spark, docs):
    """The query against another reader of the format's chunks, sums worked out cell by cell, and cosines by their definition."""
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    stored = {r["doc_id"]: bytes(r["media"]) for r in media.with_media(docs).select("doc_id", "media").collect()}
    found = {r["doc_id"]: r for r in media.op5_media(spark, SF).collect()}
    assert found.keys() == texts.keys()
    for i, raw in texts.items():
        payload, r = raw + b"\0" * (-len(raw) % 64 if raw else 64), found[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(payload[-64:]), len(stored[i]), hashlib.sha256(stored[i]).hexdigest())
    for i in sorted(texts)[:20]:
        raw = texts[i]
        image = np.frombuffer(raw + b"\0" * (-len(raw) % 64 if raw else 64), np.uint8).reshape(-1, 64).astype(float)
        n = len(image)
        edges = [k * n // 32 for k in range(33)]
        small = np.array([[image[a : max(b, a + 1), 2 * j : 2 * j + 2].mean() for j in range(32)] for a, b in itertools.pairwise(edges)])
        low = np.array([[sum(small[y, x] * math.cos(math.pi * (2 * y + 1) * u / 64) * math.cos(math.pi * (2 * x + 1) * v / 64) for y in range(32) for x in range(32)) for v in range(8)] for u in range(8)])
        low = np.round(low.ravel(), 6)
        assert found[i]["feature"] == np.packbits(low > np.median(low[1:])).tobytes().hex()


@needs_tables
def test_bpe_against_the_library(docs):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    texts = [r["text"] for r in docs.collect()]
    texts += ["", "It's <|endoftext|> O'NEIL's 123 ÀÉ Σίσυφος ΟΔΟΣ İstanbul é 日本語 🤗🤗👍", "a" * 700 + " " + "the" * 300 + "!!!" * 200, "<|endoftext|", "ẞİΣ <|startoftext|>x"]
    words = bpe.vocabulary(path)
    ids, at = words.encode(texts)
    for k, t in enumerate(texts):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[at[k] : at[k + 1]].tolist() == want
        assert words.decode(ids[at[k] : at[k + 1]]) == library.decode(want, skip_special_tokens=False)


def test_bpe_code_points():
    """Every code point, in a word, as a word and beside a digit, as the library encodes it."""
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    library, words = Tokenizer.from_file(path), bpe.vocabulary(path)
    library.no_truncation()
    library.no_padding()
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(codes), 20_000):
        texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}" for c in codes[k : k + 20_000]]
        ids, at = words.encode(texts)
        for i, one in enumerate(library.encode_batch(texts, add_special_tokens=False)):
            assert ids[at[i] : at[i + 1]].tolist() == one.ids, hex(codes[k + i])


def test_network_gradients():
    net = toxicity.Network(3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    words = toxicity.Words(["hello you there this is a test of words", "short text", ""])
    at, text = words.windows()
    y = np.array([1.0, 0.0, 1.0])[text]
    loss = lambda: float((np.logaddexp(0, z := net.logits(words, at)) - y * z).mean())
    g = net.gradients(words, at, y, np.ones(len(at)))
    for k, w in net.w.items():
        flat, slope = w.ravel(), np.asarray(g[k]).ravel()
        for i in np.argsort(-np.abs(slope))[:3]:
            was = flat[i]
            flat[i] = was + 1e-3
            high = loss()
            flat[i] = was - 1e-3
            low = loss()
            flat[i] = was
            assert abs((high - low) / 2e-3 - slope[i]) < 3e-4 + 0.02 * abs(slope[i])


def test_toxicity_learns():
    rng = np.random.default_rng(4)
    plain = [f"{a}{b}" for a in ("ta", "re", "mi", "so", "lu") for b in ("non", "ver", "da", "kel", "ist", "um")]
    texts, labels = [], []
    for k in range(400):
        words = [plain[i] for i in rng.integers(0, len(plain), rng.integers(20, 150))]
        if k % 4 == 0:
            words[rng.integers(0, len(words))] = ["zogmar", "zogtil", "qwepp", "zogfin"][rng.integers(0, 4)]
        texts.append(" ".join(words))
        labels.append(int(k % 4 == 0))
    net = toxicity.train(texts[:320], np.array(labels[:320]), rounds=5)
    predicted = net.scores(texts[320:]) >= 0.5
    assert (predicted == np.array(labels[320:])).mean() > 0.9


@needs_tables
def test_language_held_out(spark):
    from meridian.llm.common import held_out

    rows = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held_out", held_out())
    found = language.identify(rows, language.prototypes(rows.where("not held_out")), keep=("lang", "held_out"))
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


@needs_tables
def test_oracles(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        df, rel = queries.QUERIES[name](spark, SF), con.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns)
        key = lambda r: str(r)
        assert sorted(map(tuple, df.select(*rel.columns).collect()), key=key) == sorted(rel.fetchall(), key=key), name


@needs_tables
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]
    rows = found.collect()
    assert len(rows) > 100 and all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def tree(leaves):
    """Root of some digests by the definition, and the siblings (left, right) of each leaf, level by level."""
    path, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for p, k in zip(path, at, strict=True):
            run = k - k % 3
            p.append(("".join(level[run:k]), "".join(level[k + 1 : run + 3])))
        at = [k // 3 for k in at]
        level = [hashlib.sha256("".join(level[k : k + 3]).encode()).hexdigest() for k in range(0, len(level), 3)]
    return level[0], path


@pytest.mark.parametrize("span", [1, 2, 6])
def test_manifest(spark, span):
    """Trees of 1 to 100 leaves, whole in one bucket of levels or cut into many."""
    sizes = {None: 5, "": 1, "b": 100, "a": 27, "é": 28, "z": 3}
    rows = [(k * 11 % n, name, f"{name}-{k * 11 % n}") for name, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = merkle.manifest(df, merkle.digest(F.col("text")), keep=("doc_id", "source"), span=span)
    found = found.withColumns({"folded": merkle.folded(F.col("leaf")), "proof": merkle.proof_digest(), "wrong": merkle.folded(F.sha2("root", 256))}).collect()
    h = lambda t: hashlib.sha256(f"{len(t.encode())}:{t}".encode()).hexdigest()
    names = sorted(sizes, key=lambda n: (n is not None, (n or "").encode()))
    inner = {n: tree([h(f"{n}-{k}") for k in range(sizes[n])]) for n in names}
    root, above = tree([inner[n][0] for n in names])
    assert len(found) == len(rows)
    for r in found:
        path = inner[r["source"]][1][r["doc_id"]] + above[names.index(r["source"])]
        assert r["leaf"] == h(f"{r['source']}-{r['doc_id']}") and r["subroot"] == inner[r["source"]][0] and r["root"] == r["folded"] == root != r["wrong"]
        assert list(zip(r["left"], r["right"], strict=True)) == path
        assert r["proof"] == hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest()


def all_runs(words):
    """Runs by the definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(words[i : i + size - p] == words[i + p : i + size] for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs():
    rng = np.random.default_rng(3)
    for _ in range(400):
        texts = []
        for kind in rng.integers(0, 4, rng.integers(0, 5)):
            part = np.tile(rng.integers(0, 2, rng.integers(1, 5)), rng.integers(1, 6))
            texts.append([rng.integers(0, 2, 50), np.tile(rng.integers(0, 3, rng.integers(1, 9)), 6), np.tile(part, 5), np.tile(np.append(part, 2), 4)][kind].tolist())
        words = np.array([w for t in texts for w in t], np.int64)
        found = periodic.find_runs(words, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
        at = np.cumsum([0, *map(len, texts)])
        assert list(zip(*(x.tolist() for x in found), strict=True)) == [(a + s, n, q) for a, t in zip(at, texts, strict=False) for s, n, q in all_runs(t)]


@needs_tables
def test_periodic_query(spark, docs):
    want = {}
    for r in docs.collect():
        words, h = WORDS.findall((r["text"] or "").encode()), zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = all_runs(words)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = min(((-size, s, q) for s, size, q in runs), default=None)
        top = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()
        want[r["doc_id"]] = (len(runs), *top, hashlib.sha256(lines).hexdigest(), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())
    found = periodic.op12_periodic(spark, SF).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == want and any(w[0] for w in want.values())


@pytest.fixture(scope="module")
def ranks():
    import tiktoken

    path, pattern = byte_bpe.default_vocabulary(), byte_bpe.default_pattern()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={}), byte_bpe.vocabulary(path, pattern)


@needs_tables
def test_byte_bpe_query(spark, docs, ranks):
    library, _ = ranks
    want = {}
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    assert {r["doc_id"]: tuple(r)[1:] for r in byte_bpe.op13_byte_bpe(spark, SF).collect()} == want


def test_byte_bpe_like_the_library(ranks):
    """Every code point, alone and beside others, and pieces that make the encoder go back."""
    library, words = ranks
    codes = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = np.random.default_rng(7)
    texts = [" ".join(f"a{c}b {c} 1{c}  {c}{c}" for c in codes[k : k + 50]) for k in range(0, len(codes), 50)]
    texts += ["".join(rng.choice(list("abetaoin"), rng.integers(0, 300))) for _ in range(500)] + ["a" * n for n in range(200)] + ["ab" * 20_000]
    for k in range(0, len(texts), 2000):
        ids, at = words.encode(texts[k : k + 2000])
        for i, want in enumerate(library.encode_ordinary_batch(texts[k : k + 2000])):
            assert ids[at[i] : at[i + 1]].tolist() == want
            assert bytes(words.decode(np.array(want, np.int64), np.array([0, len(want)]))[0]) == texts[k + i].encode()


def test_byte_bpe_by_merges():
    """A small vocabulary in which merges overlap, against merging by rank."""
    ranks = {bytes([b]): b for b in range(256)}
    for k, t in enumerate((b"ab", b"ba", b"aa", b"aba", b"bab", b"abab", b"aaaa", b"baa")):
        ranks[t] = 256 + k
    words = byte_bpe.Ranks(ranks, r"[^|]+")
    rng = np.random.default_rng(2)
    for _ in range(500):
        text = bytes(rng.choice([97, 98], rng.integers(1, 40)).tolist())
        parts = [text[i : i + 1] for i in range(len(text))]
        while text not in ranks:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(itertools.pairwise(parts)) if a + b in ranks), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        want = [ranks[text]] if text in ranks else [ranks[p] for p in parts]
        assert words.encode_pieces([text])[0].tolist() == want and (text in ranks or words._back(text) == want)
    with pytest.raises(ValueError):
        byte_bpe.Ranks({bytes([b]): b for b in range(255)}, r".")
    with pytest.raises(KeyError):
        words.decode(np.array([999]), np.array([0, 1]))


def _points(sizes, rng):
    flips = rng.integers(0, 64, (len(sizes), 12))
    fp = np.bitwise_xor.reduce(np.uint64(1) << flips.astype(np.uint64), axis=1)
    return pa.table({"doc_id": np.arange(len(sizes)), "fp": fp.view(np.int64), "fp2": np.zeros(len(sizes), np.int64), "size": sizes, "own": np.ones(len(sizes), bool)})


def test_near_copies_pass_over_other_sizes(monkeypatch):
    """All close pairs of sizes near each other are found, and most pairs of other sizes are not gone through."""
    rng, seen, count = np.random.default_rng(3), [], np.bitwise_count
    table = _points(np.sort((10 ** rng.uniform(0, 4, 2000)).astype(np.int64)), rng)
    monkeypatch.setattr(simhash.np, "bitwise_count", lambda x: seen.append(x.size) or count(x))
    found = {(i, j) for a, b, _ in simhash._close(table, 16, 0.8) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    fp, size = table.column("fp").to_numpy().view(np.uint64), table.column("size").to_numpy()
    near = (count(fp[:, None] ^ fp) <= 16) & (size[:, None] >= 0.8 * size)
    assert found == {(i, j) for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1))), strict=True)} and found
    assert sum(seen) / 2 < 2000 * 2000 / 6


def test_near_copies_at_crowded_anchors(spark, monkeypatch):
    """An anchor with too many pairs is cut by size: each point goes to two classes, and to stripes only in a class that is too large itself."""
    sizes = [1 + k % 40 * (k % 40) for k in range(1200)] + [5000] * 300
    rows = [(k, 0, 0, size) for k, size in enumerate(sizes)]
    monkeypatch.setattr(simhash, "PAIRS", 20_000)
    monkeypatch.setattr(simhash, "MEET", 256)
    points = spark.createDataFrame(rows, "doc_id long, fp long, fp2 long, size long")
    met = simhash.meetings(points, 1, (0,), 0.8).where("anchor = 0").collect()
    groups = {}
    for r in met:
        groups.setdefault((r["class"], r["one"], r["two"]), []).append((r["size"], r["doc_id"], r["own"]))
    assert max(map(len, groups.values())) < 400 and len(met) < 2 * 1200 + 300 * 6
    want = {(i, j) for i, x in enumerate(sizes) for j, y in enumerate(sizes) if (x, i) < (y, j) and x >= 0.8 * y}
    pairs = {(i, j) for rows in groups.values() for x, i, own in rows if own for y, j, _ in rows if (x, i) < (y, j)}
    assert want <= pairs


def test_byte_dedup_sorts_only_what_meets(monkeypatch):
    """A piece whose anchor no other piece of the shard has is settled without a suffix array."""
    rng, sorted_bytes, array = np.random.default_rng(4), [], byte_dedup.suffix_array
    monkeypatch.setattr(byte_dedup, "suffix_array", lambda s: sorted_bytes.append(len(s)) or array(s))
    texts = [rng.integers(97, 123, 60, np.uint8).tobytes() for _ in range(100)]
    texts += [texts[0], texts[1][:52] + b"########"]  # a copy, and one with three windows of another
    anchor = [*range(100), 0, 1]
    row = (7, 0, 102, np.array(anchor, np.uint32).tobytes(), np.full(102, 10, np.uint8).tobytes(), b"".join(texts), byte_dedup.narrow(np.arange(102)), b"", np.arange(102, dtype=np.uint32).tobytes())
    gone = byte_dedup._shard((pa.scalar(7),), byte_dedup.packed_table([row], byte_dedup.PIECES), 50, 1 << 20)
    places, windows = (np.frombuffer(gone.column(c)[0].as_py(), np.uint32).tolist() for c in ("places", "windows"))
    assert dict(zip(places, windows, strict=True)) == {100: 0b11111111111, 101: 0b111}
    assert sorted_bytes and max(sorted_bytes) == 2 * 61
