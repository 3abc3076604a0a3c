"""Named queries of the ten operators and of the pipeline, with SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm import (
    hadamard,
    langid,
    linededup,
    linequality,
    lshjoin,
    mixing,
    rangejoin,
    substrings,
    suffixdedup,
    tokencount,
    tokenids,
    transducer,
    variants,
)
from hazardgrid.session import configure, shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Arrow batches by bytes, so that long texts do not pile up in one batch.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    shared_dir(spark)  # where that is unset, it names one for checkpoints
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file; ``TOKENIZERS_DIR`` overrides the installed ones."""
    import public_tokenizers

    folder = os.environ.get("TOKENIZERS_DIR")
    return f"{folder}/{name}" if folder else public_tokenizers.path(name)


@query
def op1_token_ids(spark, sf):
    return tokenids.token_ids(spark, table(spark, sf, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)


@query
def op2_ngram_jaccard_join(spark, sf):
    return lshjoin.join_similar(spark, table(spark, sf, "documents"))


@query
def op3_embedding_near_dedup(spark, sf):
    return rangejoin.join_near(spark, table(spark, sf, "embeddings"))


@query
def op4_source_mixing(spark, sf):
    plan = mixing.plan_mix(spark, table(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_language_id(spark, sf):
    return langid.identify(table(spark, sf, "documents"))


@query
def op6_substring_dedup(spark, sf):
    cut = substrings.remove_repeated(spark, table(spark, sf, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_sentencepiece_round_trip(spark, sf):
    model = tokenizer("piece_bpe_32k.model")
    coded = transducer.encode(table(spark, sf, "documents").select("doc_id", "text"), model)
    return transducer.decode(coded, model).select(
        "doc_id", "n_tokens", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op8_line_dedup(spark, sf):
    cut = linededup.dedup_lines(spark, table(spark, sf, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("llm_lines").alias("n_lines"),
        F.col("llm_dropped").alias("n_dropped"),
        F.sha2("llm_kept", 256).alias("kept_sha256"),
    )


@query
def op9_line_quality(spark, sf):
    return linequality.judge(spark, table(spark, sf, "documents"))


@query
def line_quality_small_hosts(spark, sf):
    """The same judgement for hosts of few documents: a line may be in three of them."""
    return linequality.judge(spark, table(spark, sf, "documents"), min_docs=3)


@query
def op10_token_counts(spark, sf):
    return tokencount.count_tokens(table(spark, sf, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op11_spelling_variants(spark, sf):
    return variants.group_variants(spark, table(spark, sf, "documents"))


@query
def op12_centroid_clustering(spark, sf):
    return hadamard.cluster(spark, table(spark, sf, "embeddings"))


@query
def op13_suffix_array_dedup(spark, sf):
    cut = suffixdedup.remove_repeated(spark, table(spark, sf, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


ORACLES["op8_line_dedup"] = r"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM cut
), shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > s.first, false) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES["op9_line_quality"] = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM doc
), gram AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, g1, g2, g3, g4, g5) AS times
  FROM (
    SELECT doc_id, pos, word AS g1, lead(word, 1) OVER w AS g2, lead(word, 2) OVER w AS g3,
           lead(word, 3) OVER w AS g4, lead(word, 4) OVER w AS g5
    FROM word WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
  ) WHERE g5 IS NOT NULL
), covered AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n
  FROM gram, (SELECT unnest([0, 1, 2, 3, 4]) AS k) WHERE times >= 2 GROUP BY doc_id
), line AS (
  SELECT doc_id, host, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) > 0 AS full_line,
         translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM doc)
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM line WHERE full_line GROUP BY doc_id
), above AS (
  SELECT l.host, key, min(doc_id) AS first FROM line l
  JOIN (SELECT host, count(DISTINCT doc_id) AS docs FROM doc GROUP BY host) h ON l.host = h.host
  WHERE full_line GROUP BY l.host, key, h.docs
  HAVING count(DISTINCT doc_id) > 50 AND count(DISTINCT doc_id) > 0.02::DOUBLE * h.docs
), gone AS (
  SELECT doc_id, sum(l.words) AS n FROM line l
  JOIN above a ON l.host = a.host AND l.key = a.key AND l.doc_id > a.first WHERE full_line GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, len(d.words)::BIGINT AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(g.n, 0)::BIGINT AS n_line_words
  FROM doc d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN dup ON dup.doc_id = d.doc_id
  LEFT JOIN gone g ON g.doc_id = d.doc_id
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * n_line_words <= n_words AS kept
FROM counts
"""

ORACLES["line_quality_small_hosts"] = ORACLES["op9_line_quality"].replace("> 50 AND", "> 3 AND")

ORACLES["op4_source_mixing"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS turn_key
  FROM documents
), ranked AS (
  SELECT source, source_size, 3 * source_size AS full_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS sno
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM doc GROUP BY source)
), weighed AS (
  SELECT *, (sno - 1) % 3 + 1 AS w FROM ranked
), fill(step, cut) AS (  -- cut whatever exceeds its ceiling until nothing does
  SELECT 0, []::BIGINT[]
  UNION ALL
  SELECT step + 1, next FROM (
    SELECT f.step, f.cut,
      (SELECT list(sno ORDER BY sno) FROM weighed x WHERE list_contains(f.cut, sno)
         OR w * ((SELECT sum(source_size) FROM weighed)
                 - (SELECT coalesce(sum(full_size), 0) FROM weighed y WHERE list_contains(f.cut, y.sno)))
            >= full_size::HUGEINT * (SELECT sum(w) FROM weighed y WHERE NOT list_contains(f.cut, y.sno))) AS next
    FROM fill f) WHERE len(coalesce(next, []::BIGINT[])) > len(cut)
), final AS (SELECT cut FROM fill ORDER BY step DESC LIMIT 1
), split AS (
  SELECT *, list_contains((SELECT cut FROM final), sno) AS cut FROM weighed
), open AS (
  SELECT (SELECT sum(source_size) FROM split) - coalesce(sum(full_size) FILTER (cut), 0) AS words,
         sum(w) FILTER (NOT cut) AS w_rest FROM split
), aimed AS (
  SELECT s.*, CASE WHEN cut THEN full_size::DOUBLE ELSE (w * o.words)::DOUBLE / o.w_rest::DOUBLE END AS target,
         (o.words // 64)::BIGINT AS seats
  FROM split s, open o
), won AS (  -- every quotient of every source, the highest ones win
  SELECT sno, count(*) AS quota FROM (
    SELECT a.sno, seats, row_number() OVER (ORDER BY w::DOUBLE / (2 * k - 1)::DOUBLE DESC, a.sno, k) AS r
    FROM aimed a, LATERAL (SELECT unnest(range(1, seats + 2)) AS k) WHERE NOT cut) WHERE r <= seats GROUP BY sno
), sources AS (
  SELECT a.*, coalesce(won.quota, 0) AS quota, greatest(least(ceil(source_size / 65536), 4096), 1)::BIGINT AS shards
  FROM aimed a LEFT JOIN won ON won.sno = a.sno
), placed AS (
  SELECT d.*, s.sno, s.source_size, s.target, s.cut, s.quota,
         ('0x' || substr(turn_key, 1, 8))::BIGINT % s.shards AS shard
  FROM doc d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), shards AS (
  SELECT sno, shard, ceil(sum(size) / 64)::BIGINT AS blocks, any_value(quota) AS quota, any_value(cut) AS cut
  FROM placed GROUP BY sno, shard
), passes AS (
  SELECT *, sum(blocks) OVER (PARTITION BY sno) AS all_blocks FROM shards
), due AS (
  SELECT *, CASE WHEN cut THEN 3 * all_blocks ELSE least(quota, 3 * all_blocks) END AS due FROM passes
), rest AS (
  SELECT *, CASE WHEN all_blocks > 0 THEN due // all_blocks ELSE 0 END AS n_passes,
         CASE WHEN all_blocks > 0 THEN due % all_blocks ELSE 0 END AS seats FROM due
), picked AS (
  SELECT sno, shard, count(*) AS chosen FROM (
    SELECT sno, shard, seats,
           row_number() OVER (PARTITION BY sno ORDER BY blocks::DOUBLE / (2 * k - 1)::DOUBLE DESC, shard, k) AS r
    FROM rest, LATERAL (SELECT unnest(range(1, blocks + 1)) AS k)) WHERE r <= seats GROUP BY sno, shard
), selected AS (
  SELECT r.sno, r.shard, blocks, n_passes, coalesce(chosen, 0) AS chosen,
         CASE WHEN blocks > 0 THEN ('0x' || substr(md5('mix-1:' || r.sno || ':' || r.shard), 1, 8))::BIGINT % blocks
              ELSE 0 END AS turn
  FROM rest r LEFT JOIN picked p ON p.sno = r.sno AND p.shard = r.shard
), laid AS (
  SELECT *, (sum(size) OVER (PARTITION BY sno, shard ORDER BY turn_key, size
                             ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS place
  FROM placed
), blocks AS (  -- each block of a shard with its words taken
  SELECT sno, shard, j, ((j + 1 + turn) * chosen) // blocks > ((j + turn) * chosen) // blocks AS own
  FROM selected, LATERAL (SELECT unnest(range(0, blocks)) AS j)
), extra AS (
  SELECT l.sno, l.shard, l.doc_id, l.place,
         sum(least((b.j + 1) * 64, l.place + l.size) - greatest(b.j * 64, l.place)) AS words
  FROM laid l JOIN blocks b ON b.sno = l.sno AND b.shard = l.shard AND b.own
   AND b.j BETWEEN l.place // 64 AND (l.place + l.size - 1) // 64
  WHERE l.size > 0 GROUP BY ALL
)
SELECT l.doc_id, l.size, l.source_size, l.target,
       (s.n_passes * l.size + coalesce(e.words, 0))::BIGINT AS taken
FROM laid l JOIN selected s ON s.sno = l.sno AND s.shard = l.shard
LEFT JOIN extra e ON e.sno = l.sno AND e.shard = l.shard AND e.doc_id = l.doc_id AND e.place = l.place
"""


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other: distances component by component, floors of exact sums."""
    steps = ["""WITH vecs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x::DOUBLE)]) = 64
), parts AS MATERIALIZED (
  SELECT rid, unnest(range(64)) AS pos, unnest(v)::BIGINT AS x FROM vecs
), firsts AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('3:' || vec_id), vec_id, v) - 1 AS cl FROM vecs
  WHERE vec_id IS NOT NULL
), c0 AS MATERIALIZED (
  SELECT cl, pos, x FROM firsts JOIN parts USING (rid) WHERE cl < %d
)""" % k]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, cl, d FROM (
    SELECT rid, cl, d, row_number() OVER (PARTITION BY rid ORDER BY d, cl) AS near FROM (
      SELECT rid, cl, sum((p.x - c.x) * (p.x - c.x)) AS d FROM parts p JOIN c{r} c USING (pos) GROUP BY rid, cl))
  WHERE near = 1
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT cl, pos, sum(x)::BIGINT AS s, count(*) AS n FROM a{r} JOIN parts USING (rid) GROUP BY cl, pos
), c{r + 1} AS MATERIALIZED (
  SELECT cl, pos, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{r} LEFT JOIN m{r} USING (cl, pos)
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, cl::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY cl))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN vecs USING (rid)
JOIN (SELECT cl, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY cl) USING (cl)
"""


ORACLES["op12_centroid_clustering"] = _clustering_sql()
