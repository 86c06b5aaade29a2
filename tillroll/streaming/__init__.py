from tillroll.streaming.ingest import read_raw_stream, stream_fact_lines  # noqa: F401
