"""The registered queries of this subpackage: one thin query per operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm import chat, exact_dedup, fingerprints, lm_score, near_dedup, neighbours, packing, prefix_trie, quality, resample, secrets, sentencepiece_codec, warc
from sigspark.llm.common import table, text_of

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


@query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(text_of(), 256).alias("text_sha256"))
    path = tokenizer(PIECES)
    found = sentencepiece_codec.decode(sentencepiece_codec.encode(rows, path, ("doc_id", "text_sha256")), path)
    same = F.sha2("text", 256) == F.col("text_sha256")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "text_sha256", same.alias("round_trip"))


@query(
    r"""
    WITH n AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS clean
      FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY clean) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept,
           sha256(clean) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY clean ORDER BY points DESC, doc_id)
    """
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts by the streaming state; one row per document."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(*exact_dedup.RESULT)


@query(
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws
      FROM documents),
    s AS (
      SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [ws]
             ELSE [ws[i : i + 3] FOR i IN range(1, len(ws) - 2)] END)) AS shingle
      FROM w),
    h AS (SELECT doc_id, md5(array_to_string(shingle, ' ')) AS sh FROM s),
    sizes AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id),
    pairs AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
      FROM h a JOIN h b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * i >= 80 * (x.n + y.n - i)),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
      SELECT doc_id, doc_id AS r FROM w
      UNION
      SELECT both_ways.a, reach.r FROM reach JOIN both_ways ON both_ways.b = reach.doc_id),
    least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
    SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
    FROM w JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """
)
def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates on shingles of four words at similarity 0.8."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, threshold=80)


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and random spans of every text."""
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(BPE))


@query(
    r"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
      UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
    r AS (
      SELECT *, 12 + length(replace(replace(role, '%', '%25'), chr(10), '%0A')) + 1 + length(text)
             + len(regexp_extract_all(text, '<\\*\|')) + 10 + 1 AS chars,
             row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    s AS (
      SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM r)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(upto) FILTER (role = 'assistant' OR pos = n) AS BIGINT) AS formatted_chars
    FROM s GROUP BY conv_id
    """
)
def op8_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-target examples of every conversation, read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    return chat.read_back(chat.examples(rows.unionByName(more)))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query(
    r"""
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS largest FROM p)
    SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN size >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN size >= 1000 AND page_id < largest THEN largest END AS refers_to
    FROM g
    """
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records in ZIP packages and read back by ranges."""
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored against the documents labelled good, with all documents as background."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@query()
def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every row whose vec_id is divisible by 50, among all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


@query(
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
             row_number() OVER (ORDER BY doc_id NULLS FIRST, sha256(coalesce(text, ''))) - 1 AS pos, count(*) OVER () AS total
      FROM documents),
    e AS (
      SELECT a.doc_id, a.n, a.text, b.text AS next_text, substr(a.text, 1, a.n - a.n // 4) || substr(b.text, 1, a.n // 4) AS edited
      FROM d a JOIN d b ON b.pos = (a.pos + 1) % a.total),
    t AS (SELECT DISTINCT unnest([text, edited]) AS text FROM e),
    w AS (SELECT text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
    h AS (
      SELECT text, [substr(md5(array_to_string(ws[i : i + 4], ' ')), 1, 12)
                    FOR i IN range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - 3, 2) END)] AS hs
      FROM w),
    k AS (SELECT text, hs, list_sort(list_distinct([x FOR x IN hs IF x < '400000000000'])) AS low FROM h),
    s AS (SELECT text, CASE WHEN len(low) > 0 OR len(hs) = 0 THEN low ELSE [list_min(hs)] END AS sketch FROM k),
    r AS (
      SELECT e.*, x.sketch AS own, y.sketch AS other, z.sketch AS later
      FROM e JOIN s x ON x.text = e.text JOIN s y ON y.text = e.edited JOIN s z ON z.text = e.next_text)
    SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
           array_to_string(own, '') AS fingerprint, array_to_string(other, '') AS edited_fingerprint,
           CASE WHEN least(len(own), len(other)) > 0 THEN CAST(len(list_intersect(own, other)) AS DOUBLE) / least(len(own), len(other))
                ELSE CAST(len(own) = len(other) AS DOUBLE) END AS near_edited,
           CASE WHEN least(len(own), len(later)) > 0 THEN CAST(len(list_intersect(own, later)) AS DOUBLE) / least(len(own), len(later))
                ELSE CAST(len(own) = len(later) AS DOUBLE) END AS near_next
    FROM r
    """
)
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled sketches of every document and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH crc_table AS (
      SELECT list(list_reduce([CAST(b AS BIGINT)] || range(8),
                  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
      FROM range(256) r(b)),
    texts AS (
      SELECT 0 AS target, doc_id AS id, coalesce(text, '') AS text FROM documents
      UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark),
    w AS (
      SELECT target, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM texts),
    f AS (
      SELECT target, id, unnest(ws || [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) AS feature FROM w),
    d AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM f),
    c AS (
      SELECT feature, xor(list_reduce(
        [4294967295] || [(instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1 FOR i IN range(1, len(h), 2)],
        lambda s, b: xor(s // 256, t[xor(s % 256, b) + 1])), 4294967295) % 10000 AS bucket
      FROM d, crc_table),
    n AS (
      SELECT target, id, bucket, count(*) AS n FROM f JOIN c USING (feature) GROUP BY ALL),
    totals AS (
      SELECT CAST(coalesce(sum(n) FILTER (target = 0), 0) AS BIGINT) AS s, CAST(coalesce(sum(n) FILTER (target = 1), 0) AS BIGINT) AS t FROM n),
    per_bucket AS (
      SELECT bucket, CAST(coalesce(sum(n) FILTER (target = 0), 0) AS BIGINT) AS s, CAST(coalesce(sum(n) FILTER (target = 1), 0) AS BIGINT) AS t
      FROM n GROUP BY bucket),
    gains AS (
      SELECT bucket, CAST(floor(1000 * ln(CAST((b.t + 1) * (a.s + 10000) AS DOUBLE) / CAST((b.s + 1) * (a.t + 10000) AS DOUBLE))) AS BIGINT) AS gain
      FROM per_bucket b, totals a),
    sums AS (
      SELECT id, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
      FROM n JOIN gains USING (bucket) WHERE target = 0 GROUP BY id),
    scored AS (
      SELECT w.id AS doc_id, len(ws) AS words, CAST(len(ws) + greatest(len(ws) - 1, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || w.id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM w LEFT JOIN sums ON sums.id = w.id WHERE target = 0),
    placed AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank
    FROM scored LEFT JOIN placed USING (doc_id)
    """
)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn to look like the benchmark's items."""
    drawn = resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    r"""
    WITH crc_table AS (
      SELECT list(list_reduce([CAST(b AS BIGINT)] || range(8),
                  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
      FROM range(256) r(b)),
    turns AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM turns),
    plan AS (
      SELECT conv_id, conv_id - conv_id % 5 AS base,
             xor(list_reduce([4294967295] || [ascii(name[i]) FOR i IN range(1, length(name) + 1)],
                             lambda s, b: xor(s // 256, t[xor(s % 256, b) + 1])), 4294967295) % 9 AS h
      FROM convs, crc_table),
    parts AS (
      SELECT p.conv_id, 0 AS part, t.pos, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.base AND t.pos <= p.h
      UNION ALL
      SELECT p.conv_id, 1, t.pos, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.pos > p.h),
    rebuilt AS (
      SELECT conv_id, row_number() OVER w AS depth, text,
             string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING) AS path
      FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
    rows AS (
      SELECT conv_id, depth, strlen(text) AS bytes, path FROM rebuilt
      UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
    lengths AS (SELECT conv_id, max(depth) AS length FROM rows GROUP BY conv_id),
    nodes AS (
      SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '') AS ends
      FROM rows JOIN lengths USING (conv_id) GROUP BY path, depth),
    children AS (
      SELECT n.path, n.depth, count(c.path) AS n_children
      FROM nodes n LEFT JOIN nodes c ON c.depth = n.depth + 1 AND substr(c.path, 1, 64 * n.depth) = n.path GROUP BY ALL),
    above AS (
      SELECT a.path, a.depth, n.n_convs, n.bytes, k.n_children
      FROM nodes n JOIN children k USING (path, depth) JOIN rows a ON a.conv_id = n.conv_id AND a.depth <= n.depth),
    sums AS (
      SELECT path, depth, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
      FROM above GROUP BY ALL)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
    FROM nodes n JOIN children USING (path, depth) JOIN sums USING (path, depth)
    LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, 64 * (n.depth - 1))
    """
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations rebuilt on the heads of others."""
    conv = F.col("conv_id")
    trie = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), conv - conv % 5, F.crc32(conv.cast("string")) % 9)
    return trie.drop("ref")
