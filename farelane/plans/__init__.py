"""The jobs users call: cleaning, reports, publishing, ingest."""
