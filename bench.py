"""Seconds for whole rankings of the documents table: 3, 30 and 300 queries, with and without the rest.

Prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of cores.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from quillrank import Options, rank_documents
from quillrank.plans import registry
from quillrank.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("quillrank-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    documents = tables.documents_as_articles(tables.read_table(spark, SF_DIR, "documents"))
    turns = tables.user_turns_as_queries(tables.read_table(spark, SF_DIR, "conversations"))

    def workload(count: int, **options):
        # The first queries by number, so that every run has the same ones.
        chosen = turns.orderBy("query_id").limit(count)
        return lambda: rank_documents(chosen, documents, Options(**options))

    runs = {
        "rank_3": workload(3),
        "rank_30": workload(30),
        "rank_300": workload(300),
        "rank_3_keep_duplicates": workload(3, dedup=False),
        "rank_30_keep_duplicates": workload(30, dedup=False),
        "rank_300_keep_duplicates": workload(300, dedup=False),
        "rank_300_unstemmed": workload(300, stem=False),
        "article_text": lambda: registry.article_text(spark, SF_DIR),
        "corpus_stats": lambda: registry.corpus_stats(spark, SF_DIR),
        "query_scores": lambda: registry.query_scores(spark, SF_DIR),
        "user_query_scores": lambda: registry.user_query_scores(spark, SF_DIR),
        "user_query_top10": lambda: registry.user_query_top10(spark, SF_DIR),
        "stemmed_ranking": lambda: registry.QUERIES["stemmed_ranking"](spark, SF_DIR),
        "deduplicated_top10": lambda: registry.QUERIES["deduplicated_top10"](spark, SF_DIR),
        "document_ranking": lambda: registry.document_ranking(spark, SF_DIR),
    }
    timed(runs["rank_3"])  # warm-up: JVM, code generation, Python workers
    seconds = {}
    for name, run in runs.items():
        seconds[name] = timed(run)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
    print(json.dumps({
        "metric": "seconds for all bench queries, after one warm-up",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
