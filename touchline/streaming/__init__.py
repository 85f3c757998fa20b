"""The two jobs that also run as streams: resumable ingest and fixture scoring."""
