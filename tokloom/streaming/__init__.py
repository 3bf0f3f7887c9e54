from tokloom.streaming.ingest import ingest_available_now, streaming_counts  # noqa: F401
