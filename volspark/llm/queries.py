"""Registered queries of the subpackage: thin contracts over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.llm import (
    bpe,
    centroids,
    decontam,
    embed_dedup,
    langid,
    licenses,
    packing,
    quality,
    resampling,
    secrets,
    simhash,
    urls,
    warc,
)
from volspark.session import ensure_conf, keep, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url by rule, or else by the character language-model ratio."""
    return urls.judge(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, at most 3 differing bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label at cosine 0.98 or more."""
    found = embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)
    return found.withColumnRenamed("id", "vec_id")


OP3_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x <> 0]) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label
      WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r(id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT id, min(other) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""


def op4_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, one row per piece."""
    placed = packing.pack(_table(spark, sf_dir, "documents"), tokenizer or packing.vocabulary())
    return placed.withColumnRenamed("id", "doc_id")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, trained on the three quarters that may train."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.Model(langid.training_samples(docs))
    return langid.identify(docs, model).select(
        F.col("id").alias("doc_id"), (~langid.trainable("id")).alias("held_out"), "lang_pred", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to shared storage and read back by its index."""
    folder = scratch_path(spark, "warc")
    index = warc.write(_table(spark, sf_dir, "pages"), folder)
    return warc.read(index, folder, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
        CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the three base kinds, and what the Markov models add."""
    found = secrets.find(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[secrets.count(F.col("base"), kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]], F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


def _op7_sql() -> str:
    """The base patterns by split positions, and the Markov models over the whole table."""
    def sql(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def parts(text: str, pattern: str) -> str:
        return f"string_split(regexp_replace({text}, {sql(pattern)}, chr(1) || '\\0' || chr(1), 'g'), chr(1))"

    assigned = f"length(regexp_extract(x, {sql(secrets.ASSIGN)}, 2)) >= {secrets.MIN_ASSIGNED}"
    kinds = (("assign", secrets.ASSIGN, assigned), ("access", secrets.ACCESS_LONG, "true"),
             ("hex", secrets.HEX_LONG, "true"))
    matches = " UNION ALL ".join(f"SELECT doc_id, {k} AS rank, {parts('t', pattern)} AS parts FROM t"
                                 for k, (_, pattern, _) in enumerate(kinds))
    masked, last = [], "t"
    for name, pattern, ok in kinds:
        masked.append(f"""m_{name} AS (SELECT doc_id, array_to_string([CASE WHEN i % 2 = 0 AND {ok}
            THEN repeat(' ', length(x)) ELSE x END FOR x, i IN {parts('t', pattern)}], '') AS t FROM {last})""")
        last = f"m_{name}"
    token = f"[A-Za-z0-9+/_=-]{{{secrets.MIN_TOKEN},}}"
    start = "coalesce(list_sum([length(x) FOR x IN parts[1:i - 1]]), 0)"
    return f"""
WITH t AS (SELECT doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
{", ".join(masked)},
found AS (SELECT doc_id, rank, {start} AS start, parts[i] AS x
    FROM (SELECT doc_id, rank, parts, unnest(range(2, len(parts) + 1, 2)) AS i FROM ({matches}))),
base AS (SELECT doc_id, rank, start, start + length(x) AS stop FROM found WHERE rank > 0 OR {assigned}),
sample AS (
    SELECT 1 AS random, unnest([x FOR x IN regexp_extract_all(t, {sql(secrets.ASSIGN)}, 2)
        IF length(x) >= {secrets.MIN_ASSIGNED}]) AS x FROM t
    UNION ALL SELECT 1, unnest(regexp_extract_all(t, {sql(secrets.ACCESS_LONG)})) FROM t
    UNION ALL SELECT 1, unnest(regexp_extract_all(t, {sql(secrets.HEX_LONG)})) FROM t
    UNION ALL SELECT 0, unnest([x FOR x IN regexp_extract_all(t, '[A-Za-z0-9+/_=-]{{{secrets.MIN_ORDINARY},}}')
        IF regexp_matches(x, {sql(secrets.IDENTIFIER)})]) FROM {last}),
step AS (SELECT random, ascii(x[i]) AS a, ascii(x[i + 1]) AS b
    FROM (SELECT random, x, unnest(range(1, length(x))) AS i FROM sample)),
n AS (SELECT random, a, b, count(*) AS n FROM step GROUP BY ALL),
s AS (SELECT random, a, sum(n) AS n FROM n GROUP BY ALL),
g AS (SELECT a, b FROM range(128) x(a), range(128) y(b)),
ratio AS (SELECT g.a, g.b, {" - ".join(
    f"ln((coalesce(n{k}.n, 0) + {secrets.SMOOTHING}) / (coalesce(s{k}.n, 0) + {secrets.SMOOTHING * secrets.CODES}))"
    for k in (1, 0))} AS r FROM g
    {" ".join(f"LEFT JOIN n n{k} ON n{k}.random = {k} AND n{k}.a = g.a AND n{k}.b = g.b "
              f"LEFT JOIN s s{k} ON s{k}.random = {k} AND s{k}.a = g.a" for k in (0, 1))}
    WHERE (SELECT count(DISTINCT random) FROM step) = 2),
long AS (SELECT doc_id, {start} AS start, parts[i] AS x
    FROM (SELECT doc_id, parts, unnest(range(2, len(parts) + 1, 2)) AS i
          FROM (SELECT doc_id, {parts('t', token)} AS parts FROM {last}))),
added AS (SELECT doc_id, 3 AS rank, start, start + length(x) AS stop
    FROM (SELECT doc_id, start, x, unnest(range(1, length(x))) AS i FROM long)
    JOIN ratio ON a = ascii(x[i]) AND b = ascii(x[i + 1])
    GROUP BY doc_id, start, x HAVING sum(r) / (length(x) - 1) >= {secrets.MIN_RATIO}),
spans AS (SELECT *, ['assign', 'access', 'hex', 'markov'][rank + 1] || ':' || start || ':' || stop AS span
    FROM (FROM base UNION ALL FROM added)),
out AS (SELECT doc_id, {", ".join(f"count(*) FILTER (rank = {k}) AS n_{name}" for k, (name, _, _) in enumerate(kinds))},
    string_agg(span, ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base,
    string_agg(span, ',' ORDER BY start, rank, stop) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{name}, 0) AS BIGINT) AS n_{name}" for name, _, _ in kinds)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN out USING (doc_id)
"""


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside an occurrence of a benchmark window of 10 words."""
    found = decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
o AS (
    SELECT doc_id, i, k, item_id
    FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
          CROSS JOIN (SELECT DISTINCT k FROM p) WHERE i + k - 1 <= len(w))
    JOIN p USING (phrase, k)),
h AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM o) GROUP BY doc_id),
t AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, trained on the four fifths that may train."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        F.col("id").alias("doc_id"), (~quality.trainable("id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document, by containment of their five-word shingles."""
    return licenses.scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+') IF x <> ''] AS w
    FROM documents),
t(license, text) AS (VALUES @),
tw AS (
    SELECT license, [x FOR x IN regexp_split_to_array(lower(text), '[^\pL\pN]+') IF x <> ''] AS w FROM t),
ts AS (SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM tw)),
tc AS (SELECT license, count(*) AS n, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS c FROM ts GROUP BY license),
o AS (SELECT doc_id, license, s, p, n, c
      FROM (SELECT doc_id, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))
      JOIN ts USING (s) JOIN tc USING (license)),
v AS (SELECT doc_id, license, k, count(DISTINCT s) / n AS containment
      FROM (SELECT *, unnest([p // c, p // c - 1]) AS k FROM o) WHERE k >= 0
      GROUP BY doc_id, license, k, n HAVING count(DISTINCT s) / n >= 0.8),
g AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) AS n_windows,
          max(containment) AS containment FROM v GROUP BY doc_id)
SELECT doc_id, coalesce(licenses, '') AS licenses, CAST(coalesce(n_windows, 0) AS BIGINT) AS n_windows,
    coalesce(containment, 0.0) AS containment
FROM d LEFT JOIN g USING (doc_id)
""".replace("@", ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all whole 64-component vectors after ten rounds, exact in integers."""
    found, means = centroids.cluster(_table(spark, sf_dir, "embeddings"), k=8, rounds=10)
    digests = F.array(*[F.lit(centroids.centroid_digest(c)) for c in means]).cast("array<string>")
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        F.get(digests, F.col("cluster")).alias("centroid_sha256"))


def _op11_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after another, over one row per vector and component."""
    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
    SELECT r, arg_min(c, row(distance, c)) AS c, min(distance) AS distance
    FROM (SELECT r, c, sum((x.x - c{n}.x) * (x.x - c{n}.x)) AS distance FROM x JOIN c{n} USING (i) GROUP BY r, c)
    GROUP BY r)"""

    def moved(n: int) -> str:
        return f"""c{n + 1} AS MATERIALIZED (
    SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, c{n}.x) AS x FROM c{n} LEFT JOIN (
        SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{n} USING (r) GROUP BY c, i) USING (c, i))"""

    steps = ",\n".join(step for n in range(rounds) for step in (assigned(n), moved(n)))
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        [CAST(floor(1024 * x) AS BIGINT) FOR x IN CAST(embedding AS DOUBLE[])] AS e
    FROM embeddings WHERE len(embedding) = 64
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(e) AS x FROM v),
f AS (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), e) - 1 AS c, e FROM v WHERE vec_id IS NOT NULL),
c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS i, unnest(e) AS x FROM f WHERE c < {k}),
{steps},
{assigned(rounds)},
d AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN d USING (c)
"""


def op12_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    """Every document encoded by the byte-level ranks and decoded again, as digests."""
    path = ranks or bpe.ranks_path()
    # stored: the decoder reads what was written, and one Python worker a core is enough
    encoded = keep(_table(spark, sf_dir, "documents").select(
        "doc_id", bpe.encoded(F.col("text"), path, bpe.split_pattern()).alias("ids")), "bpe-ids")
    return encoded.select(
        "doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("ids"), path), 256).alias("decoded_sha256"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights of all documents towards the benchmark, and the tenth that is drawn."""
    found = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                percent=10, min_words=20)
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


OP13_SQL = r"""
WITH code AS (
    SELECT list(list_reduce([c] || range(8), lambda r, _: CASE WHEN r & 1 = 1
        THEN xor(3988292384, r >> 1) ELSE r >> 1 END) ORDER BY c) AS t
    FROM (SELECT unnest(range(256)) AS c)),
w AS MATERIALIZED (
    SELECT kind, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT 's' AS kind, row_number() OVER () AS r, doc_id, text FROM documents
          UNION ALL SELECT 't', 0, 0, text FROM benchmark)),
f AS MATERIALIZED (SELECT kind, r, unnest(w) AS g FROM w),
h AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM f)),
b AS MATERIALIZED (
    SELECT g, xor(list_reduce([4294967295] || [CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(len(x) // 2)],
        lambda r, c: xor(r >> 8, t[xor(r, c) % 256 + 1])), 4294967295) % 10000 AS b FROM h, code),
n AS (SELECT b, count(*) FILTER (kind = 's') AS s, count(*) FILTER (kind = 't') AS t FROM f JOIN b USING (g) GROUP BY b),
a AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM n),
gain AS (
    SELECT b, CAST(floor(1000 * ln((CAST(n.t + 1 AS DOUBLE) * (a.s + 10000)) / (CAST(n.s + 1 AS DOUBLE) * (a.t + 10000))))
        AS BIGINT) AS gain FROM n, a),
weight AS (
    SELECT r, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n_features
    FROM f JOIN b USING (g) JOIN gain USING (b) WHERE kind = 's' GROUP BY r),
scored AS (
    SELECT r, doc_id, coalesce(n_features, 0) AS n_features,
        coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
        CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT)
            + 0.5) / 4294967296))) AS BIGINT) AS draw
    FROM w LEFT JOIN weight USING (r) WHERE kind = 's'),
ranked AS (
    SELECT r, row_number() OVER (ORDER BY weight + draw DESC, doc_id NULLS LAST, weight, n_features) AS rank
    FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(weight + draw AS BIGINT) AS score,
    CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""


def registry():
    """Query name -> callable(spark, sf_dir)."""
    return {"op1_urls": op1_urls,
            "op2_simhash": op2_simhash,
            "op3_embeddings": op3_embeddings,
            "op4_packing": op4_packing,
            "op5_langid": op5_langid,
            "op6_warc": op6_warc,
            "op7_secrets": op7_secrets,
            "op8_decontam": op8_decontam,
            "op9_quality": op9_quality,
            "op10_licenses": op10_licenses,
            "op11_centroids": op11_centroids,
            "op12_bpe": op12_bpe,
            "op13_resampling": op13_resampling}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op3_embeddings": OP3_SQL, "op6_warc": OP6_SQL, "op7_secrets": _op7_sql(),
            "op8_decontam": OP8_SQL, "op10_licenses": OP10_SQL, "op11_centroids": _op11_sql(),
            "op13_resampling": OP13_SQL}
