"""Batch ranked retrieval over large text collections, written as Spark DataFrame jobs."""

from quillrank.index import ArticleIndex, read_index, write_index
from quillrank.operators.assembly import document_rankings
from quillrank.plans.retrieval import Options, rank_documents

__all__ = ["ArticleIndex", "Options", "document_rankings", "rank_documents", "read_index", "write_index"]
