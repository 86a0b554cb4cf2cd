"""Given tables as Spark frames and as plain rows, and letters that are hard to encode."""

import pyarrow.parquet as pq

ALPHABET = [
    " ", " ", "\n", "\t", "\r", "a", "B", "it's", "'s", "é", "1", ",", "!", "\x1c", "\x85", "　", "\xa0", "ſ", "²", "漢",
    "<|endoftext|>", "<|startoftext|>", "<|", "́", "😀", "'", "Σ", "İ", "ﬁ", "zq", "</w>",
]


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def read_rows(sf, table, columns=("doc_id", "text")):
    found = pq.read_table(f"{sf}/{table}.parquet", columns=list(columns)).to_pydict()
    return list(zip(*(found[c] for c in columns), strict=True))
