"""Sources: fixed-schema CSV ingest with corrupt-line routing, and the fixture view."""
