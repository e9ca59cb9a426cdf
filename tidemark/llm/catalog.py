"""Registered queries of the operators, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, chunks, jaccard, lexical, merkle, packing, quality, sharding, subword, token_counts, tokenize, topk, toxicity
from tidemark.llm.bytebpe import TokenizerFile
from tidemark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RANKS = "byte_bpe_multi_50k.tiktoken"
MERGES = "byte_bpe_50k.json"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the library, and batches to Python of a size that few texts fill.

    The default batch of 64 MB is held several times over, by the JVM and by a worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return configure(spark)


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> TokenizerFile:
    return TokenizerFile.read(public_tokenizers.path(name))


@query("op1_bpe")
def op1_bpe(spark, sf_dir):
    """Every text of documents encoded, and its ids decoded."""
    return tokenize.round_trip(table(spark, sf_dir, "documents"), tokenizer(RANKS))


@query("op2_sharding")
def op2_sharding(spark, sf_dir):
    """All documents in 16 shards of near equal bytes, by virtual slots."""
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16)


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    """Tokens of every text of documents, counted by the compiled transducer."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer(MERGES), limit=512)


@query("op4_packing")
def op4_packing(spark, sf_dir):
    """All documents packed into windows of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(MERGES))


@query("op5_quality")
def op5_quality(spark, sf_dir):
    """Statistics and verdict of every document, robust outliers per language and source."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op6_substring")
def op6_substring(spark, sf_dir):
    """Documents that repeat a passage of an earlier document, and what is left of them."""
    return chunks.repeats(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


JACCARD_SQL = r"""
WITH RECURSIVE lowered AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END AS s
    FROM lowered
), entries AS (SELECT doc_id, unnest(s) AS shingle, len(s) AS n FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r USING (doc_id)
"""


@query("op8_jaccard", JACCARD_SQL)
def op8_jaccard(spark, sf_dir):
    """Components of all documents under shingle similarity of 3/4 or more."""
    return jaccard.join_components(table(spark, sf_dir, "documents"))


# Derived from conversations: a user's turn calls the tool "reply", the turn after it answers.
REPLY = {
    "reply": {
        "type": "object",
        "properties": {
            "prompt": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0},
            "words": {"type": "integer", "minimum": 0},
        },
        "required": ["prompt", "turn"],
        "additionalProperties": False,
    }
}


@query("op9_chat")
def op9_chat(spark, sf_dir):
    """Every user turn as a call, after the call two turns before, with the answer in the next turn."""
    turns = table(spark, sf_dir, "conversations")
    name = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    calls = turns.where("role = 'user'").select(
        F.col("conv_id").alias("conv"), name(F.col("turn")).alias("call"), F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn", F.when(F.col("text").isNotNull(), words).alias("words"))).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(name(F.col("turn") - 2))).alias("after"),
    )
    results = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), name(F.col("turn") - 1).alias("call"), F.col("text").alias("content")
    )
    return chat.link_calls(calls, results, REPLY)


TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10
"""


@query("op10_topk", TOP_K_SQL)
def op10_topk(spark, sf_dir):
    """The ten best other vectors of every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


# CRC-32 with its reflected polynomial, bit by bit, before its last inversion; a level of the recursion is a level of all trees.
MERKLE_SQL = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, source, lang, n_chars, text,
           CASE WHEN doc_id IS NOT NULL AND list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
               lambda a, b: list_reduce([xor(a, b)] || CAST(range(8) AS BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) % 5 = 4294967295 % 5
           THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS tried
    FROM documents
), leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(tried) || ':' || tried, '-')) AS changed
    FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM fields)
), trees AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS size FROM leaves GROUP BY source
), placed AS (
    SELECT doc_id, leaf, changed, tree, size, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
    FROM leaves JOIN trees ON leaves.source IS NOT DISTINCT FROM trees.source
), nodes AS (
    SELECT 0 AS level, tree, idx, leaf AS digest, size FROM placed
    UNION ALL
    SELECT level + 1, tree, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (size + 15) // 16 FROM nodes WHERE size > 1 GROUP BY level, tree, idx // 16, size
), tops AS (SELECT tree, digest FROM nodes WHERE size = 1),
crown AS (
    SELECT 0 AS level, tree AS idx, digest, (SELECT count(*) FROM tops) AS size FROM tops
    UNION ALL
    SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (size + 15) // 16 FROM crown WHERE size > 1 GROUP BY level, idx // 16, size
), all_nodes AS (
    SELECT level, tree, idx, digest, size FROM nodes WHERE size > 1
    UNION ALL SELECT 1000 + level, -1, idx, digest, size FROM crown WHERE size > 1
), walked AS (
    SELECT doc_id, leaf, tree AS home, idx AS place, CASE WHEN size > 1 THEN tree ELSE -1 END AS tree, CASE WHEN size > 1 THEN idx ELSE tree END AS idx,
           CASE WHEN size > 1 THEN 0 ELSE 1000 END AS level, size, changed AS folded, '' AS proof, false AS done
    FROM placed
    UNION ALL
    SELECT doc_id, leaf, home, place, CASE WHEN n.size <= 16 THEN -1 ELSE w.tree END,
           CASE WHEN w.tree = -1 OR n.size > 16 THEN w.idx // 16 ELSE home END,
           CASE WHEN w.tree = -1 OR n.size > 16 THEN w.level + 1 ELSE 1000 END, n.size,
           sha256(n.before || folded || n.after), proof || n.before || n.after, w.tree = -1 AND n.size <= 16
    FROM walked w JOIN (
        SELECT a.level, a.tree, a.idx, a.size, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS before,
               coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS after
        FROM all_nodes a JOIN all_nodes b ON a.level = b.level AND a.tree = b.tree AND a.idx // 16 = b.idx // 16 GROUP BY ALL
    ) n ON n.level = w.level AND n.tree = w.tree AND n.idx = w.idx WHERE NOT w.done
)
SELECT doc_id, leaf, t.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM walked w JOIN tops t ON t.tree = w.home CROSS JOIN (SELECT digest FROM crown WHERE size = 1) r
WHERE w.done OR (SELECT count(*) FROM tops) = 1 AND w.tree = -1
"""


@query("op11_merkle", MERKLE_SQL)
def op11_merkle(spark, sf_dir):
    """Leaf, subroot, root and proof of every document, and what the proofs say after a trial."""
    return merkle.verify(table(spark, sf_dir, "documents"))


@query("op12_quality_classifier")
def op12_quality_classifier(spark, sf_dir):
    """Quality of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return subword.score(docs, subword.fit(docs, table(spark, sf_dir, "labels")))


SEARCH_SQL = r"""
WITH lists AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM lists WHERE len(w) > 0),
postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM lists) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, totals GROUP BY term, docs
), wanted AS (
    SELECT item, item_id, term, count(*) AS times FROM (
        SELECT row_number() OVER () AS item, item_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ) GROUP BY ALL
), scored AS (
    SELECT item, item_id, row, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN postings USING (term) CROSS JOIN totals GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""


@query("op13_lexical", SEARCH_SQL)
def op13_lexical(spark, sf_dir):
    """The twenty best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
