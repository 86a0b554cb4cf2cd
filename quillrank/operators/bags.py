"""The token store of a corpus, term bags of its articles, and the statistics that follow from them.

Articles are read and analysed once, into a stored row each: what names it, its length, and its tokens with their counts. All
else reads columns of that store: the vocabulary its tokens, statistics its lengths, matches its tokens again. Tokens meet the
vocabulary in the stage that reads them, so what is shuffled are matches only: one short row per article and term. Articles travel
as a row without tokens each, to meet their bags.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.tokens import counted
from quillrank.operators.analysis import article_tokens
from quillrank.operators.bloom import may_have_partner
from quillrank.storage import broadcast_if_small, checkpointed

# What tells one candidate from another. Ids need not be unique. The fingerprint is a sha256 of id,
# title and all tokens, so equal articles, and only they, share it.
CANDIDATE = ["id", "title", "length", "fingerprint"]

_COPIED_ROWS, _COPIED_BYTES, _COPIED_WIDTH = 1_000_000, 64 << 20, 64

def _fingerprint() -> Column:
    # Lengths in front make the parts unambiguous; tokens hold no spaces.
    parts = [F.length("id").cast("string"), F.col("id"), F.length("title").cast("string"), F.col("title")]
    return F.unhex(F.sha2(F.concat_ws(" ", *parts, F.array_join("tokens", " ")), 256))


def token_store(articles: DataFrame) -> DataFrame:
    """(fingerprint, id, title, length, entries): every usable article with its distinct tokens, as (token, tf) each.

    ``length`` counts all tokens. Copies of an article are rows of their own.
    """
    return article_tokens(articles).select(
        _fingerprint().alias("fingerprint"), "id", "title", F.size("tokens").alias("length"),
        counted(F.col("tokens")).alias("entries"),
    )


def article_lengths(rows: DataFrame) -> DataFrame:
    """(length, copies): how many rows of a token store have how many tokens."""
    return rows.groupBy("length").agg(F.count("*").alias("copies"))


def corpus_tokens(store: DataFrame) -> DataFrame:
    """The distinct tokens of a token store, in column ``token``."""
    return store.select(F.explode("entries.token").alias("token")).distinct()


def matches(store: DataFrame, token_terms: DataFrame | None) -> DataFrame:
    """(fingerprint, term, tf): the terms of every article of a token store, once for equal articles.

    ``token_terms`` (token, term) tells which tokens count, and as what; None counts every token as itself. It joins
    before the shuffle if it is hinted to be broadcast.
    """
    entries = store.select("fingerprint", F.explode("entries").alias("entry"))
    rows = entries.select("fingerprint", F.col("entry.token").alias("token"), F.col("entry.tf").cast("bigint").alias("tf"))
    if token_terms is None:
        return rows.groupBy("fingerprint", F.col("token").alias("term")).agg(F.max("tf").alias("tf"))
    # Equal articles have equal counts, so the largest stands for all copies.
    once = rows.join(token_terms, "token").groupBy("fingerprint", "token", "term").agg(F.max("tf").alias("tf"))
    return once.groupBy("fingerprint", "term").agg(F.sum("tf").alias("tf"))


def article_bags(store: DataFrame, found: DataFrame) -> DataFrame:
    """(id, title, length, fingerprint, bag, copies): every article that has matches, equal ones together.

    ``bag`` holds (token, tf) of its matches ``found``, sorted by term. The result is dealt by fingerprint.
    """
    partitions = int(store.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(partitions, "fingerprint")
    bags = dealt.groupBy("fingerprint").agg(
        F.array_sort(F.collect_list(F.struct(F.col("term").alias("token"), "tf"))).alias("bag")
    )
    distinct = store.select(*CANDIDATE).groupBy(*CANDIDATE).agg(F.count("*").alias("copies"))
    return bags.join(distinct, "fingerprint").select(*CANDIDATE, "bag", "copies")


def corpus_stats(lengths: DataFrame) -> DataFrame:
    """One row from ``lengths`` (length, copies): documents, their total length, and the mean length with its fraction cut off."""
    totals = lengths.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(F.col("copies") * F.col("length")), F.lit(0)).alias("total_len"),
    )
    mean = F.call_function("div", F.col("total_len"), F.col("n_docs")).cast("double")
    return totals.withColumn("avg_len", F.when(F.col("n_docs") > 0, mean))


def postings(bags: DataFrame, keys: list[str] = CANDIDATE) -> DataFrame:
    """(keys, copies, term, tf): one row per candidate and term."""
    return bags.select(*keys, "copies", F.explode("bag").alias("entry")).select(
        *keys, "copies", F.col("entry.token").alias("term"), F.col("entry.tf").cast("bigint").alias("tf")
    )


def term_frequencies(postings: DataFrame) -> DataFrame:
    """(term, cf): occurrences of each term in the whole corpus."""
    return postings.groupBy("term").agg(F.sum(F.col("tf") * F.col("copies")).alias("cf"))


def once_each(store: DataFrame) -> DataFrame:
    """(fingerprint, id, length, entries): the articles of a token store, equal ones as one row.

    Fingerprints are counted first, so only articles that do have copies travel.
    """
    rows = store.select("fingerprint", "id", "length", "entries")
    counts = store.groupBy("fingerprint").agg(F.count("*").alias("n"))
    copied = checkpointed(counts.where("n > 1").select("fingerprint"))
    if copied.isEmpty():
        return rows
    copied = broadcast_if_small(copied, F.lit(_COPIED_WIDTH), _COPIED_ROWS, _COPIED_BYTES)
    one_of_copies = rows.join(copied, "fingerprint", "left_semi").dropDuplicates(["fingerprint"])
    return rows.join(copied, "fingerprint", "left_anti").union(one_of_copies)


def counted_once(store: DataFrame) -> DataFrame:
    """(CANDIDATE, copies, entries): the articles of a token store, equal ones as one row with their count."""
    copied = checkpointed(store.groupBy("fingerprint").agg(F.count("*").alias("copies")).where("copies > 1"))
    rows = store.select(*CANDIDATE, "entries")
    if copied.isEmpty():
        return rows.select(*CANDIDATE, F.lit(1).cast("bigint").alias("copies"), "entries")
    copied = broadcast_if_small(copied, F.lit(_COPIED_WIDTH), _COPIED_ROWS, _COPIED_BYTES)
    single = rows.join(copied, "fingerprint", "left_anti").withColumn("copies", F.lit(1).cast("bigint"))
    columns = [*CANDIDATE, "copies", "entries"]
    return single.select(columns).union(rows.join(copied, "fingerprint").dropDuplicates(["fingerprint"]).select(columns))


def store_frequencies(store: DataFrame, token_terms: DataFrame) -> DataFrame:
    """(term, cf): occurrences of each term in a token store. ``token_terms`` (token, term) comes hinted to be broadcast."""
    rows = store.select(F.explode("entries").alias("entry")).select(
        F.col("entry.token").alias("token"), F.col("entry.tf").cast("bigint").alias("tf")
    )
    return rows.join(token_terms, "token").groupBy("term").agg(F.sum("tf").alias("cf"))


def store_postings(store: DataFrame, terms: DataFrame, is_small: bool, keys: list[str]) -> DataFrame:
    """(keys, term, tf): a row for each of ``terms`` (term) in each row of a token store; tokens are their own terms here.

    If ``terms``, a stored table of distinct terms, is small, it comes hinted to be broadcast and nothing is shuffled. Else rows
    meet a Bloom filter before they are.
    """
    # A plain explode would have Spark test the size of the entries, and so analyse the text, once more in the scan.
    rows = store.select(*keys, F.explode_outer("entries").alias("entry")).select(
        *keys, F.col("entry.token").alias("term"), F.col("entry.tf").cast("bigint").alias("tf")
    )
    return (rows if is_small else may_have_partner(rows, terms, "term")).join(terms, "term").select(*keys, "term", "tf")
