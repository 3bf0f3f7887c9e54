"""Catalogue queries for streaming ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokloom.functions.text import py_strip
from tokloom.streaming import ingest_available_now, streaming_counts


def _docs_schema(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").schema


def _stripped(df):
    t = py_strip("text")
    return (df.select("doc_id", "source", "lang", t.alias("_t")).where(F.length("_t") > 0)
            .select("doc_id", "source", "lang",
                    F.octet_length("_t").cast("long").alias("n_bytes")))


def _docs_path(sf):
    """The documents table as a pattern, which a stream takes for a file as well
    as for a folder of files (a plain path has to be a folder)."""
    return f"{sf}/documents.parque[t]"


def q_ingest_available_now(spark, sf):
    """R1 over the documents table: stripped, non-blank rows, 30 files per
    source dataset; all its files arrive at once, so it equals the batch quota
    query however many there are."""
    path = ingest_available_now(
        spark, _docs_path(sf), _docs_schema(spark, sf), _stripped, order=["doc_id"],
        size_col="n_bytes", group=["source"], max_files=30, files_per_trigger=None)
    return spark.read.parquet(path).select("doc_id", "source", "n_bytes")


def q_ingest_counts(spark, sf):
    path = streaming_counts(spark, _docs_path(sf), _docs_schema(spark, sf), _stripped,
                            group=["lang"], size_col="n_bytes")
    return spark.read.parquet(path).select("lang", "n_rows", "n_bytes")


QUERIES = {
    "ingest_available_now": q_ingest_available_now,
    "ingest_counts": q_ingest_counts,
}
