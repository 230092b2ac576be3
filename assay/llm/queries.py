"""Registered queries of the dealt operators, each next to its check SQL where SQL can express it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import (
    chat,
    clustering,
    decontaminate,
    fixity,
    langid,
    licenses,
    near_dup,
    packing,
    quality,
    runs,
    sharding,
    suffix_dedup,
    toxicity,
)
from assay.llm.common import Scratch, bound_batches, crc_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, crc_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id",
        (crc_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judge(docs, quality.fit(docs, labels))


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, crc_remainder("doc_id", 3) != 1)
    held_out = (crc_remainder("doc_id", 3) == 1).alias("held_out")
    return langid.identify(docs, model).select("doc_id", held_out, "lang_pred", "score", "rejected")


def packing_sql(documents: str, buckets: int, budget: int) -> str:
    """The same boundaries by dynamic programming over all pairs of lengths, then batches by rank."""
    layers = "".join(
        f""",
    f{k} AS (SELECT seg.i, min(f.cost + seg.cost) AS cost, arg_min(seg.j, (f.cost + seg.cost) * 1000000 + seg.j) AS j
        FROM seg JOIN f{k - 1} AS f ON f.i = seg.j GROUP BY seg.i)"""
        for k in range(2, buckets + 1)
    )
    walk = "".join(
        f""",
    e{k} AS (SELECT f{k}.j AS i FROM f{k} JOIN e{k + 1} AS e ON f{k}.i = e.i WHERE e.i > 0)"""
        for k in range(buckets, 1, -1)
    )
    ends = " UNION ".join(f"SELECT i FROM e{k}" for k in range(buckets + 1, 1, -1))
    return f"""
WITH lengths AS MATERIALIZED (
    SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+'))::BIGINT AS n_tokens FROM {documents}),
hist AS (
    SELECT n_tokens AS length, count(*)::BIGINT AS n, sum(n_tokens)::BIGINT AS tokens FROM lengths GROUP BY 1),
cum AS MATERIALIZED (
    SELECT length, row_number() OVER w AS i, (sum(n) OVER w)::BIGINT AS c, (sum(tokens) OVER w)::BIGINT AS t FROM hist WINDOW w AS (ORDER BY length)),
ends0 AS MATERIALIZED (SELECT i, length, c, t FROM cum UNION ALL SELECT 0, -1, 0, 0),
seg AS MATERIALIZED (
    SELECT a.i AS j, b.i AS i, b.length * (b.c - a.c) - (b.t - a.t) AS cost FROM ends0 a JOIN ends0 b ON a.i < b.i
    UNION ALL SELECT 0, 0, 0),
f1 AS (SELECT i, cost FROM seg WHERE j = 0){layers},
e{buckets + 1} AS (SELECT max(i) AS i FROM cum){walk},
bounds AS (
    SELECT length AS padded_length, (row_number() OVER (ORDER BY length) - 1)::INT AS bucket FROM cum WHERE i IN ({ends})),
placed AS (
    SELECT l.doc_id, l.n_tokens, b.bucket, b.padded_length,
        greatest(1, {budget} // greatest(b.padded_length, 1)) AS fits,
        row_number() OVER (PARTITION BY b.bucket ORDER BY md5(l.doc_id::VARCHAR), l.doc_id) - 1 AS place
    FROM lengths l ASOF JOIN bounds b ON l.n_tokens <= b.padded_length)
SELECT doc_id, n_tokens, bucket, padded_length, (place // fits)::BIGINT AS batch, (place % fits)::BIGINT AS slot,
    padded_length > {budget} AS oversize
FROM placed"""


@query("op1_packing", packing_sql("documents", 8, 32_768))
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket and batch of every document."""
    return packing.pack(packing.word_lengths(table(spark, sf_dir, "documents")))


SHARDS = 40


def hilbert_sql(documents: str, shards: int) -> str:
    """CRC-32 byte by byte, the curve step by step in nested selects, then ranks over all rows."""
    label = "('0x' || substr(md5(coalesce({}, '')), 1, 4))::INT & {}"
    most = (1 << sharding.BITS) - 1
    curve = f"""SELECT doc_id, size, text_crc32,
        least({most}, (length(bin(size)) - 1) * 2 + coalesce(try_cast(substr(bin(size), 2, 1) AS INT), 0))::INT AS x0,
        {label.format('source', most)} AS x1, {label.format('lang', most)} AS x2, 0 AS flip FROM sized"""
    for step in sharding.curve_steps(3, sharding.BITS, "xor({0}, {1})"):
        curve = f"SELECT * REPLACE ({', '.join(f'{v} AS {k}' for k, v in step.items())}) FROM ({curve})"
    return f"""
WITH t AS MATERIALIZED (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS crcs),
bytes AS (
    SELECT doc_id, source, lang, octet_length(encode(coalesce(text, ''))) + 16 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
    FROM {documents}),
sized AS MATERIALIZED (
    SELECT doc_id, source, lang, size::BIGINT AS size, xor(list_reduce(b, lambda c, x:
        xor(c // 256, crcs[xor(c, x) % 256 + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32 FROM bytes, t),
curve AS (SELECT doc_id, size, text_crc32, ({sharding.curve_index(3, sharding.BITS)})::INT AS hilbert FROM ({curve})),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY hilbert, md5(doc_id::VARCHAR), doc_id) - 1 AS place, count(*) OVER () AS n FROM curve),
placed AS (SELECT *, place * {shards} // n AS shard FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, (place - (shard * n + {shards - 1}) // {shards})::BIGINT AS slot,
    NULL::INT AS grown_shard, hilbert FROM placed"""


@query("op7_hilbert", hilbert_sql("documents", SHARDS))
def op7_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document along the curve, row counts at most one apart."""
    docs = sharding.described(table(spark, sf_dir, "documents"))
    return sharding.shard_by_curve(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def decontaminate_sql(documents: str, span: int = 10) -> str:
    """Every window of every item compared with every window of every document."""
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM {documents}),
b AS MATERIALIZED (SELECT item_id, {words} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, span, array_to_string(w[i : i + span - 1], ' ') AS win
    FROM (SELECT item_id, w, least(len(w), {span}) AS span, unnest(range(1, len(w) - least(len(w), {span}) + 2)) AS i
        FROM b WHERE len(w) > 0)),
spans AS (SELECT DISTINCT span FROM item_windows),
doc_words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
runs AS (
    SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {span - 1} FOLLOWING) AS run
    FROM doc_words),
doc_windows AS (
    SELECT doc_id, span, i, array_to_string(run[1 : span], ' ') AS win FROM runs JOIN spans ON len(run) >= span),
hits AS MATERIALIZED (
    SELECT doc_id, i, span, item_id FROM doc_windows JOIN item_windows USING (span, win)),
words_hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + span)) AS place FROM (SELECT DISTINCT doc_id, i, span FROM hits)) GROUP BY 1),
items_hit AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS sha FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)"""


@query("op9_decontaminate", decontaminate_sql("documents"))
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def near_duplicates_sql(documents: str, percent: int) -> str:
    """Shingle sets as texts, every pair that shares a shingle, and reachability over the links."""
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^ \\x09-\\x0D]+')"
    )
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM {documents}),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
runs AS (
    SELECT doc_id, n, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS run
    FROM words),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(run, ' ') AS s FROM runs WHERE i <= greatest(1, n - 4)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b USING (s)
    WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
both_ways AS (SELECT a AS src, b AS dst FROM links UNION SELECT b, a FROM links),
reach(id, lab) AS (
    SELECT doc_id, doc_id FROM d UNION SELECT dst, lab FROM reach JOIN both_ways ON src = id),
labels AS (SELECT id, min(lab) AS component_id FROM reach GROUP BY id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN labels ON id = doc_id LEFT JOIN sizes USING (doc_id)"""


@query("op3_near_duplicates", near_duplicates_sql("documents", 85))
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), 85)


def repeats_sql(documents: str, length: int) -> str:
    """Every string of ``length`` bytes of every document, those that start twice, and what they cover."""
    return f"""
WITH d AS MATERIALIZED (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM {documents}),
strings AS MATERIALIZED (
    SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS m
    FROM (SELECT doc_id, h, unnest(range(0, n - {length} + 1)) AS i FROM d WHERE n >= {length})),
twice AS (SELECT m FROM strings GROUP BY m HAVING count(*) > 1),
starts AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {length} THEN 0 ELSE 1 END AS fresh
    FROM strings SEMI JOIN twice USING (m)),
runs AS (
    SELECT doc_id, min(i) AS lo, max(i) + {length} AS hi
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts) GROUP BY doc_id, run),
cuts AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM runs),
kept AS (
    SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(hi) AS upto,
        string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS before
    FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op4_suffix_dedup", repeats_sql("documents", 400))
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document inside strings of 400 bytes that occur elsewhere too."""
    return suffix_dedup.report(suffix_dedup.with_spans(table(spark, sf_dir, "documents")))


FIXITY_SQL = """
WITH archive AS (SELECT page_id, coalesce(url, '') || chr(10) || coalesce(html, '') AS body FROM pages),
replica AS (
    SELECT page_id, CASE WHEN page_id % 37 = 5 THEN coalesce(url, '') || chr(10) || coalesce(html, '') || '?' ELSE body END AS body
    FROM archive JOIN pages USING (page_id)
    WHERE (page_id // 64) % 16 = 3 AND page_id % 41 <> 7 OR (page_id // 64) % 16 <> 3),
sized AS (SELECT page_id, body, octet_length(encode(body)) AS n FROM archive)
SELECT s.page_id, (coalesce(sum(n) OVER (ORDER BY s.page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS offset,
    1::BIGINT AS n_records, n::BIGINT AS n_bytes, sha256(s.body) AS digest,
    CASE WHEN r.page_id IS NULL THEN 'missing' WHEN (s.page_id // 64) % 16 = 3 AND s.page_id % 37 = 5 THEN 'corrupt' ELSE 'ok' END AS status
FROM sized s LEFT JOIN replica r ON r.page_id = s.page_id"""


@query("op8_fixity", FIXITY_SQL)
def op8_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of all pages against a replica in which some ranges lost or damaged records."""
    pages = table(spark, sf_dir, "pages")
    struck = (F.expr("page_id div 64") % 16 == 3) & F.col("page_id").isNotNull()
    damaged = F.when(struck & (F.col("page_id") % 37 == 5), F.concat(F.coalesce("html", F.lit("")), F.lit("?")))
    replica = pages.filter(~struck | (F.col("page_id") % 41 != 7)).withColumn("html", damaged.otherwise(F.col("html")))
    return fixity.audit(pages, replica, "page_id", ["url", "html"])


def licenses_sql(documents: str) -> str:
    """Containment of every template in every window of every document."""
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    rows = ", ".join(f"('{k}', '{v}')" for k, v in licenses.NOTICES.items())
    return f"""
WITH notices(license_id, text) AS (VALUES {rows}),
sources AS (
    SELECT doc_id::VARCHAR AS src, {words} AS w FROM {documents} UNION ALL SELECT license_id, {words} FROM notices),
words AS (SELECT src, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM sources),
runs AS (
    SELECT src, n, i, list(word) OVER (PARTITION BY src ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS run FROM words),
shingles AS MATERIALIZED (SELECT src, i - 1 AS pos, array_to_string(run, ' ') AS s FROM runs WHERE i <= n - 4),
wanted AS (SELECT DISTINCT license_id, s FROM notices JOIN shingles ON src = license_id),
sizes AS (
    SELECT license_id, count(*) AS n, pow(2, ceil(log2(count(*))))::BIGINT AS width FROM wanted GROUP BY 1),
shapes AS (SELECT *, greatest(1, width // 4) AS stride, width + greatest(1, width // 4) - 1 AS span FROM sizes),
spots AS (
    SELECT doc_id, license_id, pos, s, n, stride, span FROM {documents} JOIN shingles ON src = doc_id::VARCHAR
    JOIN wanted USING (s) JOIN shapes USING (license_id)),
held AS (
    SELECT doc_id, license_id, n, start, count(DISTINCT s) AS shared
    FROM (SELECT *, unnest(range(greatest(0, (pos - span + stride) // stride) * stride, pos + 1, stride)) AS start FROM spots)
    GROUP BY ALL)
SELECT doc_id, license_id, max(shared / n) AS containment, count(*)::BIGINT AS n_windows, min(start)::BIGINT AS first_word
FROM held WHERE shared / n >= {licenses.CONTAINMENT} GROUP BY 1, 2"""


@query("op10_licenses", licenses_sql("documents"))
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


ESCAPES = "".join(f", '{c}', '{c[0]}\\{c[1:]}')" for c in chat.CONTROLS)
CHAT_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
    SELECT *, len('<|im_start|>') + len(url_encode(role)) + 1 + len({"replace(" * len(chat.CONTROLS)}replace(text, '\\', '\\\\'){ESCAPES})
        + len('<|im_end|>') + 1 AS chars FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""


@query("op11_chat", CHAT_SQL)
def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings in another layout, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record")
    )
    hostile = [{"role": role, "content": "</s>[INST] ok [/INST]"} for role in ("user", "assistant")]
    other = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.parse_json(F.lit(json.dumps({"messages": hostile}))).alias("record")
    )
    turns = chat.canonical_turns(rows.unionByName(other), "conv_id", "record")
    read = chat.read_back(chat.format_conversations(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss", "")
    return read.select(
        F.col("conversation").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def lloyd_sql(k: int, rounds: int, dims: int, scale: int) -> str:
    """Plain Lloyd: every distance of every round, from components in rows."""
    steps = "".join(
        f""",
a{t} AS MATERIALIZED (
    SELECT vec_id, arg_min(j, d * 1000 + j) AS j, min(d) AS d
    FROM (SELECT vec_id, j, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM parts v JOIN c{t} c USING (i) GROUP BY ALL)
    GROUP BY vec_id)"""
        + (
            f""",
c{t + 1} AS MATERIALIZED (
    SELECT c.j, c.i, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN (
        SELECT a.j, v.i, (sum(v.x) // count(*) - CASE WHEN sum(v.x) % count(*) < 0 THEN 1 ELSE 0 END)::BIGINT AS x
        FROM a{t} a JOIN parts v USING (vec_id) GROUP BY ALL) m USING (j, i))"""
            if t < rounds
            else ""
        )
        for t in range(rounds + 1)
    )
    return f"""
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS units FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
parts AS MATERIALIZED (SELECT vec_id, generate_subscripts(units, 1) AS i, unnest(units) AS x FROM usable),
seeds AS (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS j FROM usable
    QUALIFY j < {k}),
c0 AS MATERIALIZED (SELECT j, i, x FROM seeds JOIN parts USING (vec_id)){steps},
named AS (SELECT j, sha256(string_agg(x, ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY j),
sums AS (SELECT j, sum(d)::BIGINT AS inertia FROM a{rounds} GROUP BY j)
SELECT vec_id, j::INT AS cluster, d AS distance, s.inertia AS cluster_inertia,
    (SELECT sum(inertia) FROM sums)::BIGINT AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN named USING (j) JOIN sums s USING (j)"""


@query("op12_centroids", lloyd_sql(16, 3, 64, 64))
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after three exact rounds."""
    vectors = table(spark, sf_dir, "embeddings")
    scratch = Scratch(spark, "clustering")
    found = clustering.cluster(vectors, "vec_id", "embedding", dims=64, k=16, rounds=3, scale=64, seed=1, scratch=scratch)
    return clustering.report(found, "vec_id")


def planted(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth (by hash of the id) repeats a stretch of itself from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    g, n = F.expr("h div 10"), F.size("w")
    placed = split.withColumn("n", F.when(n > 0, n)).withColumn("a", g % F.col("n"))
    placed = placed.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    a, p, rest = F.col("a").cast("int"), F.col("p").cast("int"), (F.col("n") - F.col("a")).cast("int")
    times = F.ceil(rest / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", a + 1, p), times)), F.lit(1), rest)
    rewritten = F.array_join(F.concat(F.slice("w", F.lit(1), a), tail), " ")
    return placed.select("doc_id", F.when(F.col("p").isNotNull(), rewritten).otherwise(F.col("text")).alias("text"))


@query("op13_runs")
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which are rewritten to repeat themselves."""
    found = runs.periodic_runs(planted(table(spark, sf_dir, "documents")))
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["length"].alias("length"),
        (-best["p"]).alias("period"),
        F.floor(1000 * best["length"] / -best["p"]).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
