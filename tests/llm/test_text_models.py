"""Language ID, quality, packing, decontamination, WARC, licenses and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from volspark.llm import decontam, langid, licenses, packing, quality, warc
from volspark.llm.queries import oracle_sql, registry
from volspark.session import scratch_path

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def same_as_sql(spark, name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    con.execute(f"create table out as {oracle_sql()[name]}")
    got = registry()[name](spark, SF)
    assert sorted(got.columns) == sorted(r[0] for r in con.execute("describe out").fetchall())
    columns = ", ".join(got.columns)
    want = con.execute(f"select {columns} from out").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_op3_equals_sql(spark):
    same_as_sql(spark, "op3_embeddings", "embeddings")


def test_op7_equals_sql(spark):
    same_as_sql(spark, "op7_secrets", "documents")


# language ID

def greedy_phrases(text, sample):
    n = 0
    for at in range(0, len(text), langid.BLOCK):
        block, i = text[at:at + langid.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j <= len(block) and block[i:j] in sample:
                j += 1
            i, n = max(i + 1, j - 1), n + 1
    return n


def test_phrases_are_the_greedy_longest_matches():
    rng = random.Random(1)
    samples = {"a": "".join(rng.choice("abcde ") for _ in range(400)), "b": "".join(rng.choice("cdefg ") for _ in range(300))}
    model = langid.Model(samples)
    texts = ["", "a", "zzz", "".join(rng.choice("abcdefgz ") for _ in range(3000)), "abc" * 900]
    got = model.phrases(texts)
    assert got.tolist() == [[greedy_phrases(t, samples[k]) for k in model.languages] for t in texts]


def test_every_trained_character_counts():
    rng = random.Random(2)
    scripts = {"el": (0x3b1, 20), "ja": (0x3042, 80), "ru": (0x430, 30), "zh": (0x4e00, 2000), "en": (0x61, 26)}
    samples = {k: "".join(" " if rng.random() < 0.2 else chr(first + int(n * rng.random() ** 3)) for _ in range(3000))
               for k, (first, n) in scripts.items()}
    model = langid.Model(samples)
    texts = [samples[k][at:at + 200] for k in sorted(samples) for at in (0, 900, 2500)]
    texts += ["".join(rng.choice(samples["zh"] + samples["ja"] + "\u0416\u9f00z") for _ in range(1500))]
    got = model.phrases(texts)
    assert got.tolist() == [[greedy_phrases(t, samples[k]) for k in model.languages] for t in texts]
    languages, scores = model.predict(texts[:-1])
    assert languages == [k for k in sorted(samples) for _ in range(3)] and min(scores) > 0.5


def test_language_edges(spark):
    rows = [(k, w * 60, lang, "x") for k in range(40) for w, lang in (("the and of ", "en"), ("der und ich ", "de"))]
    rows += [(100, None, None, "x"), (101, "", "en", "x"), (102, "12 !? 3", None, "x"), (103, "und der", None, "x"),
             (None, "the of and", None, "x"), (104, "the of and " * 20000, None, "x"), (104, "x", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.Model(langid.training_samples(df))
    got = defaultdict(list)
    for r in langid.identify(df, model).collect():
        got[r.id].append((r.lang_pred, r.score))
    assert got[100] == got[101] == got[102] == [("und", 0.0)]
    assert got[103][0][0] == "de" and got[None][0][0] == "en" and got[104][0][0] == "en" and len(got[104]) == 2
    assert all(0 <= s <= 1 for v in got.values() for _, s in v)
    assert langid.identify(df.limit(0), model).collect() == []
    empty = langid.Model(langid.training_samples(df.limit(0)))
    assert {r.lang_pred for r in langid.identify(df, empty).collect()} == {"und"}


def test_op5_held_out_accuracy(spark):
    got = registry()["op5_langid"](spark, SF)
    truth = table(spark, "documents").select("doc_id", "lang")
    held = got.where("held_out").join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    for r in got.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


# quality

def test_op9_held_out_accuracy(spark):
    got = registry()["op9_quality"](spark, SF)
    rows = got.collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = got.where("held_out").join(table(spark, "labels").where("quality is not null"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.85 * len(held)


def test_dual_coordinate_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(50, 8, replace=False)).astype(np.int32) for _ in range(60)]
    signs = np.where([r.sum() > 200 for r in rows], 1.0, -1.0)
    values = [rng.normal(size=8) for _ in rows]
    weights = quality.dual_coordinate_descent(rows, values, signs, np.full(60, 1.0), epochs=3000)
    margins = np.array([s * (weights[r] @ v + weights[-1]) for r, v, s in zip(rows, values, signs)])
    primal = weights @ weights / 2 + np.maximum(0, 1 - margins).sum()
    for _ in range(200):                       # no nearby weights are better
        step = rng.normal(size=len(weights)) * 0.01
        step[50:-1] = 0
        w = weights + step
        m = np.array([s * (w[r] @ v + w[-1]) for r, v, s in zip(rows, values, signs)])
        assert w @ w / 2 + np.maximum(0, 1 - m).sum() >= primal - 1e-3


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "x" * 100000, "c"), (3, "again", "c"), (None, "y", "c")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).collect() == []
    both = spark.createDataFrame([(k, "good text number %d" % k) for k in range(50)]
                                 + [(k, "bad!!! &&& %d" % k) for k in range(50, 100)], "doc_id long, text string")
    model = quality.train(both, both.selectExpr("doc_id", "int(doc_id < 50) as quality"))
    got = {r.id: r.score for r in quality.score(both, model).collect()}
    assert min(got[k] for k in range(50)) > max(got[k] for k in range(50, 100))


# packing

def check_plan(histogram, capacity, **options):
    segments, n = packing.plan_sequences(histogram, capacity, **options)
    used, rooms = Counter(), defaultdict(list)
    for length, rank, count, sequence, offset, each in segments.tolist():
        for k in range(count):
            rooms[sequence + k // each].append((offset + k % each * length, length))
        used[length] += count
        assert rank >= 0
    assert used == Counter(histogram) and sorted(rooms) == list(range(n))
    for pieces in rooms.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return n


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_valid_and_near_the_bound(seed):
    rng = random.Random(seed)
    draw = [lambda: min(200, int(rng.lognormvariate(3.5, 1)) + 1), lambda: rng.randint(60, 110),
            lambda: rng.randint(1, 3), lambda: 200][seed]
    histogram = Counter(draw() for _ in range(2000))
    n = check_plan(histogram, 200)
    assert n <= -(-sum(k * v for k, v in histogram.items()) // 200) * 1.12


def test_plan_of_nothing_and_of_one():
    assert packing.plan_sequences({}, 10)[1] == 0
    assert check_plan({1: 1}, 10) == 1 and check_plan({10: 3}, 10) == 3


def test_configurations_reach_the_linear_bound():
    found = packing.configurations(np.array([30, 40, 55]), np.array([1000, 1000, 1000]), 100)
    assert all(c @ [30, 40, 55] <= 100 for c, _ in found)
    made = sum(c * t for c, t in found)
    assert (made <= 1000).all() and (made >= 990).all()
    assert sum(t for _, t in found) <= 1340      # 1000 x (55 + 40) and (30, 30, 30) x 333


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.vocabulary())
    encoder = packing.WordEncoder(packing.vocabulary())
    rng = random.Random(4)
    alphabet = "abcXYZ éÉİßẞΣσ .,!?'\"%*#&|()<>-_ ́\n\t\r€中ア\U0001f600 0129 's 're"
    texts = ["", " ", "<|endoftext|> x<|startoftext|>", "don't they're I'll", "a" * 300, "Éá Å", "café. Café! CAFÉ%%%"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(1500)]
    for text in texts * 2:
        want = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(text) == want, text


def test_op4_is_a_packing_of_the_exact_ids(spark):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.vocabulary())
    rows = registry()["op4_packing"](spark, SF).collect()
    pieces, rooms = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        rooms[r.sequence_id].append((r.offset, r.length))
    for r in table(spark, "documents").collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces.pop(r.doc_id), key=lambda p: p.piece)
        assert [(p.piece, p.start, p.length) for p in own] == [
            (k, at, len(ids[at:at + 2048])) for k, at in enumerate(range(0, len(ids), 2048))]
        for p in own:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    assert not pieces
    for room in rooms.values():
        at = 0
        for offset, length in sorted(room):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(rooms) <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_packing_edges(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "word " * 5000, "s"), (4, "dup", "s"), (4, "dup", "s"), (None, "nul", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    got = packing.pack(df, packing.vocabulary()).collect()
    encoder = packing.WordEncoder(packing.vocabulary())
    want = Counter()
    for doc, text, _ in rows:
        size = len(encoder.encode(text or "")) // 4 + 1
        want.update((doc, k, at, min(2048, size - at)) for k, at in enumerate(range(0, size, 2048)))
    assert Counter((r.id, r.piece, r.start, r.length) for r in got) == want
    places = [(r.sequence_id, r.offset) for r in got]
    assert len(set(places)) == len(places)
    assert packing.pack(df.limit(0), packing.vocabulary()).collect() == []


def test_hot_length_is_split_over_windows(spark):
    df = spark.range(500).selectExpr("id", "0 as piece", "cast(if(id < 400, 7, id % 9 + 1) as long) as length")
    got = packing.place(df, capacity=32, window_rows=16).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 500


# decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_hits(text, bench, window=10):
    words, hit, items = WORD.findall(lower(text)), set(), set()
    for item, own in bench:
        own = WORD.findall(lower(own))
        for at in range(max(1, len(own) - window + 1) if own else 0):
            phrase = own[at:at + window]
            for i in range(len(words) - len(phrase) + 1):
                if words[i:i + len(phrase)] == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    items.add(item)
    return len(words), sorted(hit), sorted(items)


@pytest.mark.parametrize("seed", range(25))
def test_shard_search_against_brute_force(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(rng.choice([1, 2, 3, 6]))]
    texts = [rng.choice([" ", ".", ", "]).join(rng.choice(words + ["OOV"] * rng.choice([0, 1, 3]))
                                               for _ in range(rng.randrange(60))) for _ in range(10)] + [None]
    bench = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 12])))) for k in range(6)]
    for text, (n, spans, items) in zip(texts, decontam.scan_shard(texts, decontam.Phrases(bench))):
        hit = [k for a, b in zip(spans[::2], spans[1::2]) for k in range(a, b)]
        assert (n, hit, items) == brute_hits(text, bench)


@pytest.mark.parametrize("seed", range(6))
def test_fm_index(seed):
    rng = np.random.default_rng(seed)
    symbols = np.append(rng.integers(0, rng.integers(2, 6), 300), 0)
    order = decontam.suffix_array(symbols)
    ends = [np.flatnonzero(symbols[i:] == 0)[0] + i for i in range(len(symbols))]
    keys = [[(1, int(s)) for s in symbols[i:e]] + [(0, e)] for i, e in enumerate(ends)]
    assert order.tolist() == sorted(range(len(symbols)), key=keys.__getitem__)
    tree = decontam.WaveletMatrix(symbols, int(symbols.max()))
    at = np.arange(len(symbols))
    found, rank = tree.access(at)
    assert (found == symbols).all()
    assert rank.tolist() == [int((symbols[:k] == symbols[k]).sum()) for k in at]


def test_op8_equals_sql(spark):
    same_as_sql(spark, "op8_decontam", "documents", "benchmark")


def test_decontamination_edges_and_blocks(spark):
    long = "clean words only here " * 8000
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, long + item + " " + long, 0), (4, item.upper(), 0), (4, item, 0),
                                  (None, "short item", 0), (5, item[:40], 0)], "doc_id long, text string, items int")
    bench = spark.createDataFrame([(1, item), (1, item), (2, "Short, item!"), (3, None), (4, ""), (None, "clean words")],
                                  "item_id long, text string")
    got = sorted((str(r.id), r.n_hit, r.items) for r in decontam.decontaminate(docs, bench).collect())
    assert got == [("1", 0, []), ("2", 0, []), ("3", 11 + 2 * 8000 * 2, [None, 1]), ("4", 11, [1]), ("4", 11, [1]), ("5", 0, []),
                   ("None", 2, [2])]
    blocks = list(decontam.phrase_blocks(bench, block_words=3))
    assert len(blocks) > 1
    many = docs.select(decontam.found_in(F.col("text"), iter(blocks), spark).alias("f")).select("f.items").collect()
    assert sorted(str([None if i == decontam.NO_ID else i for i in r["items"]]) for r in many) == sorted(
        str(x[2]) for x in got)
    assert decontam.decontaminate(docs.limit(0), bench).collect() == []
    assert {r.n_hit for r in decontam.decontaminate(docs, bench.limit(0)).collect()} == {0}


# WARC

def test_op6_equals_sql(spark):
    same_as_sql(spark, "op6_warc", "pages")


def test_warc_round_trip_and_edges(spark):
    big = "é" * 70
    rows = [(1, "http://a/\r\nX: y", big, 1), (2, None, big, 1), (3, "u", None, 1), (4, "u", "", 1), (5, "u", "<p>x\r\n\r\n</p>", 1),
            (6, "u", "short", 1), (7, "u", "short", 1), (9, "u", "z" * 300000, 1), (8, "u", "z" * 300000, 1),
            (1, "http://a/\r\nX: y", big, 1), (None, "u", big, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, length int").repartition(3)
    folder = scratch_path(spark, "warc-test")
    index = warc.write(df, folder, file_bytes=500)
    got = warc.read(index, folder, max_gap=10, range_bytes=400).collect()
    first = {big: 1, "z" * 300000: 8}
    want = Counter()
    for page, _, html, _ in rows:
        original = first.get(html)
        again = page is not None and original is not None and page != original
        want[(page, len((html or "").encode()), hashlib.sha256((html or "").encode()).hexdigest(),
              "revisit" if again else "response", original if again else None,
              None if again else (html or "").encode())] += 1
    assert Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got) == want
    few = warc.read(index.where("id = 5"), folder).collect()
    assert [bytes(r.payload) for r in few] == [b"<p>x\r\n\r\n</p>"]
    spans = warc.ranges(index, max_gap=1 << 20, range_bytes=1 << 30).collect()
    assert len(spans) == index.select("file").distinct().count()
    assert warc.read(warc.write(df.limit(0), scratch_path(spark, "warc-none")), folder).collect() == []


def test_warc_keeps_every_payload_of_a_repeated_id(spark):
    a, b, own = "a" * 150, "b" * 150, "c" * 150
    rows = [(1, "u", a), (2, "u", b), (5, "u", a), (5, "u", own), (6, "u", a), (6, "u", b), (5, "u", "short")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    folder = scratch_path(spark, "warc-repeated")
    got = warc.read(warc.write(df, folder), folder).collect()
    want = [(1, a, None), (2, b, None), (5, a, 1), (5, own, None), (6, a, 1), (6, b, 2), (5, "short", None)]
    assert Counter((r.id, r.payload_digest, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) \
        == Counter((k, hashlib.sha256(t.encode()).hexdigest(), to, None if to else t.encode()) for k, t, to in want)


def test_damaged_record_raises():
    data = warc.record(1, "u", b"payload", 7, "0" * 64, None)
    with pytest.raises(ValueError):
        warc.parse(data)


# licenses

def test_op10_equals_sql(spark):
    same_as_sql(spark, "op10_licenses", "documents")


def test_license_edges(spark):
    grant = dict(licenses.TEMPLATES)["MIT-grant"]
    words = grant.split()
    docs = spark.createDataFrame(
        [(1, None, "c"), (2, "", "c"), (3, "filler words " * 9000 + grant, "c"), (4, grant.upper().replace(" ", " \n- "), "c"),
         (4, "Released under the MIT License.", "c"), (5, " ".join(words[:12]), "c"), (None, "Released under the MIT license", "c"),
         (6, " ".join([*words[:15], "changed", *words[16:]]), "c")], "doc_id long, text string, licenses string")
    got = sorted((str(r.id), r.licenses) for r in licenses.scan(docs).collect())
    assert got == [("1", ""), ("2", ""), ("3", "MIT-grant"), ("4", "MIT"), ("4", "MIT-grant"), ("5", ""), ("6", "MIT-grant"),
                   ("None", "MIT")]
    assert licenses.scan(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        licenses.scan(docs, templates=(("short", "All rights reserved"),))


# pipeline

def test_pipeline_stages(spark):
    docs = table(spark, "documents")
    columns, kept = docs.columns, {"documents": {r.doc_id: r for r in docs.collect()}}
    bench = [tuple(r) for r in table(spark, "benchmark").collect()]
    before = kept["documents"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == corpus_pipeline.STAGES[-1][0]:
            rows = out.collect()
            assert {r.doc_id for r in rows} == set(before)
            break
        assert out.columns == columns
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count() and after.keys() <= before.keys()
        if name == "benchmark_decontamination":
            assert after.keys() == {k for k, r in before.items() if not brute_hits(r.text, bench)[1]}
        if name == "secret_scan":
            assert after.keys() == before.keys()
            for k, r in after.items():
                assert r.n_chars == len(r.text) and (r.text == before[k].text or "[secret]" in r.text)
        before = after


@pytest.mark.parametrize("languages", [2, 25])
def test_language_limit_does_not_depend_on_the_number_of_languages(spark, languages):
    rng = random.Random(languages)

    def word(letters):
        return "".join(rng.choice(letters) for _ in range(rng.randint(3, 7)))

    common = [word("abcdefghij") for _ in range(60)]
    words = [common + [word("abcdefghij") for _ in range(40)] for _ in range(languages)]
    rows = []
    for k, own in enumerate(words):
        rows += [(f"l{k:02}", " ".join(rng.choice(own) for _ in range(300))) for _ in range(20)]
    clean = len(rows)
    rows += [(None, " ".join(word("abcdefghij") for _ in range(300))) for _ in range(20)]
    docs = spark.createDataFrame([(k, text, lang) for k, (lang, text) in enumerate(rows)],
                                 "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    model = langid.Model(langid.training_samples(docs))
    assert len(model.languages) == languages
    scores = np.array(model.predict([t for _, t in rows])[1])
    # by share alone, 25 languages lose clean documents and two keep all others
    assert scores[:clean].max() < 0.3 if languages == 25 else scores.min() >= 0.5
    assert kept == set(range(clean))


def test_near_dedup_keeps_unrelated_texts_of_one_id(spark):
    rng = random.Random(3)
    a, b, c, d = (" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(200)) for _ in range(4))
    rows = [(1, a), (1, b), (2, a), (None, c), (None, c), (None, b), (None, d), (0, d), (1, a), (7, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    assert Counter(map(tuple, got.collect())) == Counter([(1, a), (1, b), (None, c), (0, d), (3, "")])


def test_pipeline_run_ends_in_pieces(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0
