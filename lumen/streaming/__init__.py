from lumen.streaming.ingest import stream_csv_to_table  # noqa: F401
