"""Centroid clustering, byte-level BPE and importance resampling against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from volspark.llm import bpe, centroids, resampling
from volspark.llm.queries import oracle_sql, registry

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name, *tables):
    import duckdb
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    con.execute(f"create table out as {oracle_sql()[name]}")
    got = registry()[name](spark, SF)
    assert sorted(got.columns) == sorted(r[0] for r in con.execute("describe out").fetchall())
    want = con.execute(f"select {', '.join(got.columns)} from out").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_op11_equals_sql(spark):
    same_as_sql(spark, "op11_centroids", "embeddings")


def test_op13_equals_sql(spark):
    same_as_sql(spark, "op13_resampling", "documents", "benchmark")


# centroid clustering

def lloyd(rows, k, rounds, dims, scale=1024):
    """(id, cluster, distance) per row, with Python's own integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    means = [v for _, v in sorted(named)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        means = [[sum(x) // len(members[c]) for x in zip(*members[c])] if c in members else m
                 for c, m in enumerate(means)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], means


def clustered(spark, rows, **kw):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit("x").alias(c) for c in ("id", "v", "cluster", "distance", "inertia")])
    return centroids.cluster(table, **kw)


@pytest.mark.parametrize("block, chunk", [(8, 4096), (3, 7), (1, 5)])
def test_clusters_equal_brute_force(spark, block, chunk):
    rng = random.Random(4)
    tops = [[rng.uniform(-1, 1) for _ in range(10)] for _ in range(5)]
    rows = [(k, [x + rng.choice([0, 0, 0.01, -0.02]) for x in rng.choice(tops)]) for k in range(160)]
    rows += [(k, tops[0]) for k in range(200, 280)]                      # copies of one vector
    rows += [(7, tops[1]), (7, tops[1]), (None, tops[2]), (None, [5.0] * 10)]
    rows += [(300, None), (301, []), (302, [1.0] * 9), (303, [1.0] * 9 + [None]),
             (304, [1.0] * 9 + [float("nan")]), (305, [1.0] * 9 + [float("-inf")])]
    got, means = clustered(spark, rows, k=6, rounds=4, dims=10, block=block, chunk=chunk)
    want, want_means = lloyd(rows, 6, 4, 10)
    assert means.tolist() == want_means
    got = got.collect()
    assert Counter((r.id, r.cluster, r.distance) for r in got) == Counter(want)
    total = sum(d for _, _, d in want)
    assert all(r.inertia == total and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) for r in got)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(k, [1.0, 0.0]) for k in range(5)] + [(9, [0.0, 0.0])]
    got, means = clustered(spark, rows, k=8, rounds=3, dims=2)
    want, want_means = lloyd(rows, 8, 3, 2)
    assert len(means) == 6 and means.tolist() == want_means             # fewer vectors than clusters
    assert Counter((r.id, r.cluster, r.distance) for r in got.collect()) == Counter(want)


def test_no_vectors(spark):
    got, means = clustered(spark, [(1, None)], k=8, rounds=2)
    assert got.collect() == [] and len(means) == 0
    got, _ = clustered(spark, [], k=8, rounds=2)
    assert got.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia"] and got.collect() == []


def test_a_component_beyond_exact_arithmetic_raises(spark):
    with pytest.raises(Exception, match="beyond"):
        clustered(spark, [(1, [1e300, 0.0])], k=1, rounds=1, dims=2)


def test_equal_subvectors_are_stored_once(spark):
    vectors = spark.range(500).select("id", F.array(*[F.lit(3).cast("long")] * 8, *[F.col("id")] * 8).alias("v"))
    chunks = centroids.encode(vectors.coalesce(1), 16, block=8, chunk=1 << 16).collect()
    assert sum(r.n for r in chunks) == 500
    assert all(len(r.dictionaries[0]) == 8 * 4 for r in chunks)          # one entry for all vectors
    assert sum(len(r.dictionaries[1]) for r in chunks) == 500 * 8 * 4


# byte-level BPE

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.read_ranks(bpe.ranks_path()))


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.ranks_path(), bpe.split_pattern())


def ids_of(library, text):
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


def odd_texts():
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [None, "", " ", "\n\n  x \t", "<|endoftext|>", "it's we'll I'D", "é́ 中文 \U0001f600\U0001f600"]
    for n in (1, 2, 7, 31, 63, 64, 65, 66, 130, 700):
        texts += ["".join(rng.choice(letters) for _ in range(n)), "ab" * n, "a" * n, " " * n + "b", "=-" * n,
                  "".join(rng.choice(["ing", "the", "tion", "er", "un"]) for _ in range(n)),
                  "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(128, 9000)])) for _ in range(n))]
    return texts


def test_ids_are_the_librarys(encoder, library):
    texts = odd_texts()
    assert encoder.encode(texts) == [ids_of(library, t) for t in texts]


def test_a_very_long_text(encoder, library):
    rng = random.Random(9)
    texts = ["word " * 400_000 + "\n" * 5000, "".join(rng.choice("abcdefgh") for _ in range(60_000)), "z" * 50_000]
    assert encoder.encode(texts) == [ids_of(library, t) for t in texts]


def test_stretches_and_a_full_cache_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 37)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(bpe, "CELLS", 256)
    small = bpe.Encoder(bpe.ranks_path(), bpe.split_pattern())
    texts = [*odd_texts(), "The quick brown fox's 12 jumps, over; the lazy dog.   And again\n\n" * 9]
    assert small.encode(texts) == [ids_of(library, t) for t in texts]


def test_pairs_are_all_two_part_cuts_of_tokens(encoder):
    rng = random.Random(10)
    tokens = {rank: token for token, rank in encoder.ranks.items()}
    pairs = [(rng.randrange(len(tokens)), rng.randrange(len(tokens))) for _ in range(3000)]
    for token, rank in list(encoder.ranks.items())[300:3000]:
        cut = rng.randrange(1, len(token))
        if token[:cut] in encoder.ranks and token[cut:] in encoder.ranks:
            pairs.append((encoder.ranks[token[:cut]], encoder.ranks[token[cut:]]))
    left, right = (np.array(side, np.int32) for side in zip(*pairs))
    want = [encoder.ranks.get(tokens[a] + tokens[b], bpe.NONE) for a, b in pairs]
    assert encoder.table.ranks(left, right).tolist() == want


def test_columns_round_trip(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([(k, t, 1, b"x") for k, t in enumerate(texts)] + [(0, None, 1, b"x")],
                                 "doc_id long, text string, ids int, bytes binary")
    ids = bpe.encoded(F.col("text"), bpe.ranks_path(), bpe.split_pattern())
    out = docs.select("*", ids.alias("tokens")).select(
        "*", bpe.decoded(F.col("tokens"), bpe.ranks_path()).alias("back"), bpe.n_tokens(F.col("tokens")).alias("n"))
    rows = out.collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert bytes(r.tokens) == ids_of(library, r.text) and r.n == len(r.tokens) // 4
        assert bytes(r.back).decode() == (r.text or "")
    assert out.where("false").collect() == []
    nothing = spark.createDataFrame([(None,)], "ids binary")
    assert nothing.select(bpe.decoded(F.col("ids"), bpe.ranks_path()).alias("b")).first().b is None


def test_an_unknown_id_is_an_error():
    decoder = bpe.Decoder(bpe.ranks_path())
    assert decoder.decode(b"") == b""
    with pytest.raises(ValueError, match="not in the rank file"):
        decoder.decode((10 ** 6).to_bytes(4, "little"))


def test_op12_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry()["op12_bpe"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = ids_of(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


# importance resampling

def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def drawn(rows, target, percent, min_words, shortest, longest, buckets):
    def features(text):
        w = words_of(text)
        return [crc32(" ".join(w[i:i + n]).encode()) % buckets
                for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
            for b in range(buckets)]
    out = []
    for i, text in rows:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(words_of(text)), len(f), weight, weight + noise, None])
    able = sorted((r for r in out if r[1] >= min_words),
                  key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[1]))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = rank
    return Counter(map(tuple, out))


def resampled(spark, rows, target, percent, min_words, **sizes):
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit("x").alias(c) for c in ("id", "t", "n", "at", "score", "rank", "weight")]).repartition(3)
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    return resampling.resample(docs, wanted, percent, min_words, **sizes)


@pytest.mark.parametrize("shortest, longest", [(1, 1), (1, 2), (2, 3)])
def test_draws_equal_brute_force(spark, shortest, longest):
    rng = random.Random(12)
    vocabulary = ["Alpha", "beta", "Été", "x2", "gamma", "中文", "d"]
    rows = [(k, rng.choice([" ", "--", "\n "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 12))))
            for k in range(120)]
    rows += [(500, None), (501, ""), (502, "  ?!"), (None, "beta beta x2 d"), (None, "beta beta x2 d"),
             (3, rows[3][1]), (600, "gamma " * 60_000)]
    target = ["alpha beta", None, "", "x2 x2 中文"]
    sizes = dict(shortest=shortest, longest=longest, buckets=97)
    got = resampled(spark, rows, target, 40, 3, **sizes)
    assert got.columns == ["id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == drawn(rows, target, 40, 3, **sizes)


def test_many_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(resampling, "COPIES", 4)
    rows = [(1, "one two three")] * 50 + [(k, "three four") for k in range(2, 60)]
    sizes = dict(shortest=1, longest=1, buckets=50)
    for percent in (10, 60, 100):
        got = Counter(map(tuple, resampled(spark, rows, ["one"], percent, 1, **sizes).collect()))
        assert got == drawn(rows, ["one"], percent, 1, **sizes)


def test_no_documents_and_no_target(spark):
    assert resampled(spark, [], ["one"], 10, 1).collect() == []
    rows = [(1, "one two"), (2, "two"), (3, None)]
    sizes = dict(shortest=1, longest=1, buckets=50)
    got = resampled(spark, rows, [], 50, 1, **sizes)
    assert Counter(map(tuple, got.collect())) == drawn(rows, [], 50, 1, **sizes)


def test_gram_lengths_are_checked(spark):
    with pytest.raises(ValueError):
        resampling.grams(spark.createDataFrame([(1, "a")], "doc_id long, text string"), shortest=0)
