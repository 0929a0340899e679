"""Structured Streaming entry points.

The reference has no streaming operator (no watermark, window or state):
every run reads complete inputs.  What lives here is its directory-of-CSV
source (S5) and record sink (K1) as a file stream, so connection logs can be
landed incrementally and the batch pipeline run over the landed table.
"""

from beatline.streaming.ingest import connection_stream, land_connections  # noqa: F401
