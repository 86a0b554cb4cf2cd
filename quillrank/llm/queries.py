"""One named query per operator, with production parameters over whole tables, and SQL where it can tell the result."""

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quillrank.llm import (
    divergence,
    exactdedup,
    forcedbpe,
    hardnegatives,
    html,
    mixing,
    oddsketch,
    packing,
    pii,
    pivots,
    quality,
    sharding,
    tokenfiles,
)
from quillrank.sources.tables import read_table
from quillrank.storage import Scratch, checkpointed


def _crc32(packed: bytes) -> int:
    """The checksum of ids packed in 16 bits, as if in 32."""
    return zlib.crc32(np.frombuffer(packed, dtype="<u2").astype("<u4").tobytes())


def _sha256(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        store = scratch.path()
        tokenfiles.write_tokens(read_table(spark, sf, "documents"), store, end_id=2)
        read = tokenfiles.read_tokens(spark, store, summary=lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
        return checkpointed(read.select("doc_id", "start", "n_tokens", F.col("summary").alias("ids_crc32")))


def op2_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        replaced = pii.with_surrogates(read_table(spark, sf, "documents"), scratch)
        return checkpointed(replaced.select("doc_id", "text", "n_entities"))


def op3_forced_bpe(spark: SparkSession, sf: str) -> DataFrame:
    encoded = forcedbpe.encode_documents(read_table(spark, sf, "documents"))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        _sha256("ids").alias("ids_sha256"),
        _sha256("decoded").alias("decoded_sha256"),
    )


def op4_pivot_links(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        return checkpointed(pivots.nearest_links(read_table(spark, sf, "embeddings"), scratch, cosine=0.98))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, sf, "documents")
    with Scratch(spark) as scratch:
        model = quality.fit(documents, read_table(spark, sf, "labels"), scratch)
    return quality.scored(documents.select("doc_id", "text"), model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.REJECT_BELOW).cast("int").alias("predicted"),
    )


def op6_feistel_shards(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        placed = sharding.shard(read_table(spark, sf, "documents"), scratch, shards=40, seed=6)
        return checkpointed(placed.select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        ))


def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exactdedup.exact_groups(read_table(spark, sf, "documents"))


def op8_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(read_table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op9_lexical_packing(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        pieces = packing.pack(read_table(spark, sf, "documents"), scratch, end_id=1, summary=_crc32)
        return checkpointed(pieces.withColumnRenamed("summary", "ids_crc32"))


def op10_odd_sketches(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        return checkpointed(oddsketch.near_groups(read_table(spark, sf, "documents"), scratch, percent=85))


def op11_mixture(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        mixed = mixing.mix(read_table(spark, sf, "documents"), scratch, weights=(5, 2, 1), percent=150, repeats=2, seed=11)
        return checkpointed(mixed.select("doc_id", "size", "source_size", "target", "taken"))


def op12_divergence(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        return checkpointed(divergence.audit(read_table(spark, sf, "documents"), scratch))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = read_table(spark, sf, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    with Scratch(spark) as scratch:
        return checkpointed(hardnegatives.hard_negatives(embeddings, F.col("vec_id") % 100 == 0, scratch))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_surrogates": op2_surrogates,
    "op3_forced_bpe": op3_forced_bpe,
    "op4_pivot_links": op4_pivot_links,
    "op5_quality": op5_quality,
    "op6_feistel_shards": op6_feistel_shards,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_html_text": op8_html_text,
    "op9_lexical_packing": op9_lexical_packing,
    "op10_odd_sketches": op10_odd_sketches,
    "op11_mixture": op11_mixture,
    "op12_divergence": op12_divergence,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}

LLM_ORACLES: dict[str, str] = {
    "op4_pivot_links": """
        WITH RECURSIVE v AS (
          SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
          WHERE label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b
          FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reached(node, root) AS (
          SELECT vec_id, vec_id FROM embeddings UNION SELECT l.a, r.root FROM reached r JOIN links l ON l.b = r.node),
        degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT node AS vec_id, coalesce(any_value(n), 0) AS n_links, min(root) AS component_id, node = min(root) AS kept
        FROM reached LEFT JOIN degrees ON a = node GROUP BY node
    """,
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_odd_sketches": """
        WITH RECURSIVE split AS (
          SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
          FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
            WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
          FROM split),
        sizes AS (SELECT doc_id, count(shingle) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
        shared AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
          FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
          SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
        reached(node, root) AS (
          SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.root FROM reached r JOIN links l ON l.b = r.node)
        SELECT node AS doc_id, any_value(n) AS n_shingles, min(root) AS component_id, node = min(root) AS kept
        FROM reached JOIN sizes ON doc_id = node GROUP BY node
    """,
    "op11_mixture": """
        WITH docs AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                 CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
          FROM documents),
        sources AS (
          SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
          FROM (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM docs GROUP BY source)),
        -- A source is at its cap if 150 % of all sizes suffice for the level at which it gets there.
        levels AS (
          SELECT a.source, a.s, a.weight,
                 2 * sum(least(2 * b.s * a.weight, b.weight * 2 * a.s)) <= 3 * sum(b.s) * a.weight AS capped
          FROM sources a, sources b GROUP BY a.source, a.s, a.weight),
        sums AS (
          SELECT sum(s) AS all_sizes, coalesce(sum(s) FILTER (capped), 0) AS capped_sizes,
                 sum(weight) FILTER (NOT capped) AS open_weights FROM levels),
        shares AS (
          SELECT source, s, CASE WHEN capped THEN 2.0::DOUBLE * s
                   ELSE CAST(weight * (3 * all_sizes - 4 * capped_sizes) AS DOUBLE) / CAST(2 * open_weights AS DOUBLE) END AS target,
                 CAST(CASE WHEN capped THEN 2 * s
                   ELSE (weight * (3 * all_sizes - 4 * capped_sizes) + open_weights) // (2 * open_weights) END AS BIGINT) AS budget
          FROM levels, sums),
        placed AS (
          SELECT doc_id, size, s AS source_size, target, budget // nullif(s, 0) AS epochs,
                 budget - budget // nullif(s, 0) * s - (sum(size) OVER (
                   PARTITION BY docs.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size) AS room
          FROM docs JOIN shares ON docs.source IS NOT DISTINCT FROM shares.source)
        SELECT doc_id, size, source_size, target,
               CAST(coalesce(epochs * size + greatest(least(room, size), 0), 0) AS BIGINT) AS taken
        FROM placed
    """,
    "op12_divergence": """
        WITH docs AS (
          SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents),
        found AS (
          SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
        kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
        sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counts AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL),
        cells AS (
          SELECT lang, source, term, coalesce(n, 0) AS n
          FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
        prices AS (
          SELECT lang, source, term, n,
                 CAST(1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS BIGINT) AS p
          FROM cells JOIN sizes USING (lang)),
        whole AS (
          SELECT lang, term, CAST(1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS BIGINT) AS q
          FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN sizes USING (lang)),
        apart AS (
          SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
          FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        above AS (
          SELECT lang, source, 'term' AS part, term AS item, p - q AS value
          FROM prices JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
              FROM (FROM pairs UNION ALL FROM above))
        WHERE part = 'pair' OR rank <= 50
    """,
    "op13_hard_negatives": """
        WITH v AS (
          SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
          SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
                 CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND len(a.q) = len(b.q)),
        positives AS (
          SELECT a, anchor_id, b AS p, id AS positive_id, score AS positive_score FROM scores WHERE same AND a <> b
          QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= 5),
        negatives AS (
          SELECT p.*, id AS negative_id, score AS negative_score,
                 row_number() OVER (PARTITION BY p.a, p ORDER BY score DESC, id) AS rank
          FROM positives p JOIN scores s ON s.a = p.a AND NOT same
            AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM negatives WHERE rank <= 10
    """,
}
