"""The registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words of 35-word windows that start anywhere else removed. Null and empty texts: no words."""
    from .substring_dedup import substring_dedup

    out = substring_dedup(_docs(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its group of texts equal after lower-casing A-Z; the largest doc_id stays. Null counts as empty."""
    from .exact_dedup import exact_groups

    out = exact_groups(_docs(spark, sf_dir))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text. Null and empty texts have none and are not over the limit."""
    import public_tokenizers

    from .tokens import count_tokens

    out = count_tokens(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 512)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text; rows with crc32(doc_id) mod 5 = 0 are held out. Null and empty texts are scored."""
    from .quality import score_quality

    return score_quality(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text, by way of a new ledger below ``spark.checkpoint.dir``. Null and empty texts have none."""
    from .secrets import BASE, scan_secrets, span_text

    found = scan_secrets(_docs(spark, sf_dir))
    base = F.filter("findings", lambda x: x["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("findings")).alias("spans"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text; ``und`` with score 0 for null and for texts without a letter."""
    from .langid import identify_languages

    return identify_languages(_docs(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates (two-word shingles, 80 %). Texts without words are alone."""
    from .near_dedup import near_groups

    return near_groups(_docs(spark, sf_dir), shingle=2).select("doc_id", "n_shingles", "component_id", "kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each (document, benchmark item) with an alignment of 0.6 or more of the item; equal ones: the first in the text."""
    from .decontaminate import find_leaks

    found = find_leaks(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "score", "begin_word", "end_word")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text. Null and empty texts have none."""
    from .pii import KINDS, find_pii

    found = find_pii(_docs(spark, sf_dir))
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["begin"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 2048 tokens. Null and empty texts are the end id alone."""
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid vector with its cluster after five exact integer k-means rounds. Other vectors are left out."""
    from .centroids import centroid_clusters

    out, clusters = centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    info = F.broadcast(clusters.select("cluster", "cluster_inertia", "inertia", "centroid_sha256"))  # CENTROIDS rows at most
    return out.join(info, "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of five-word n-gram similarity 0.8 or more. Texts without words are alone."""
    from .ngram_join import ngram_groups

    return ngram_groups(_docs(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations. Rows without a conversation id belong to none."""
    from .trie import prefix_trie, rebuilt, turn_arrays

    return prefix_trie(rebuilt(turn_arrays(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_secret_scan": op5_secret_scan,
    "op9_language_id": op9_language_id,
    "op10_near_dedup": op10_near_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_pii": op8_pii,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_ngram_join": op12_ngram_join,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op1_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(words[p : p + 34], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS p FROM w)),
dup AS (
  SELECT doc_id, p FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)),
runs AS (
  SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island FROM dup),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(min(p), max(p) + 35)) AS p FROM runs GROUP BY doc_id, island),
word AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS word FROM w),
kept AS (
  SELECT word.doc_id, string_agg(word.word, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL) AS kept_text,
         count(gone.p) AS n_removed
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
""",
    "op10_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM (SELECT g.*, n.n FROM g JOIN n ON g.doc_id = n.doc_id) a
  JOIN (SELECT g.*, n.n FROM g JOIN n ON g.doc_id = n.doc_id) b
    ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x)
SELECT reach.doc_id, any_value(coalesce(n.n, 0))::BIGINT AS n_shingles, min(r) AS component_id,
       reach.doc_id = min(r) AS kept
FROM reach LEFT JOIN n ON reach.doc_id = n.doc_id GROUP BY reach.doc_id
""",
    "op2_exact_dedup": """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
""",
}


def _centroid_sql(clusters: int = 40, rounds: int = 5) -> str:
    """The rounds written out one after the other; v: long form (vec_id, component number, value)."""
    nearest = """a{r} AS MATERIALIZED (
  SELECT row, arg_min(k, d * 1000 + k) AS k, min(d) AS d FROM (
    SELECT v.row, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c ON v.i = c.i GROUP BY v.row, c.k) GROUP BY row),"""
    moved = """c{n} AS MATERIALIZED (
  SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT a.k, v.i, CAST((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM a{r} a JOIN v ON a.row = v.row GROUP BY a.k, v.i) m ON c.k = m.k AND c.i = m.i),"""
    steps = "\n".join(nearest.replace("{r}", str(r)) + "\n" + moved.replace("{n}", str(r + 1)).replace("{r}", str(r)) for r in range(rounds))
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT row, vec_id, unnest(range(1, 65)) AS i, unnest(list_transform(e, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS x FROM e),
s AS (
  SELECT row, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, e) - 1 AS k FROM e),
c0 AS MATERIALIZED (SELECT s.k, v.i, v.x FROM v JOIN s ON v.row = s.row WHERE s.k < {clusters}),
{steps}
{nearest.replace("{r}", str(rounds))}
h AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT e.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN e ON a.row = e.row JOIN h ON a.k = h.k
"""


ORACLES["op11_centroid_clusters"] = _centroid_sql()

ORACLES["op12_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM (SELECT g.*, n.n FROM g JOIN n ON g.doc_id = n.doc_id) a
  JOIN (SELECT g.*, n.n FROM g JOIN n ON g.doc_id = n.doc_id) b
    ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x)
SELECT reach.doc_id, any_value(coalesce(n.n, 0))::BIGINT AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN n ON reach.doc_id = n.doc_id GROUP BY reach.doc_id
"""

#: h is CRC-32, bit by bit, modulo 6; DuckDB has no function for it.
ORACLES["op13_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(t ORDER BY p) AS turns, CAST(conv_id AS VARCHAR) AS s FROM t GROUP BY conv_id),
crc AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(0, 8 * len(s)), lambda i: (CAST(ascii(s[i // 8 + 1]) AS BIGINT) >> (i % 8)) & 1)),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 6 AS h
  FROM own),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1 : c.h], []), c.turns[c.h + 1 :]) AS turns
  FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
pre AS (
  SELECT conv_id, turns, d, turns[1 : d] AS prefix FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
node AS (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = d), '')) AS ends_sha256
  FROM pre GROUP BY d, prefix),
child AS (SELECT d - 1 AS d, prefix[1 : d - 1] AS prefix, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
own_sums AS (
  SELECT node.d, node.prefix, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS leaf,
         CASE WHEN node.d = 0 THEN 0 ELSE (n_convs - 1) * length(node.prefix[node.d].text) END AS saved
  FROM node LEFT JOIN child USING (d, prefix)),
below AS (
  SELECT a AS d, prefix[1 : a] AS prefix, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM own_sums) GROUP BY ALL)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, CAST(coalesce(child.n, 0) AS BIGINT) AS n_children,
       CAST(below.n_leaves AS BIGINT) AS n_leaves, CAST(below.saved_tokens AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (d, prefix) LEFT JOIN child USING (d, prefix)
LEFT JOIN node up ON up.d = node.d - 1 AND up.prefix = node.prefix[1 : node.d - 1]
"""
