"""Streaming: incremental landing of page files.

The reference refetches everything and overwrites each run; it has no
stream, watermark or state. The one streaming piece here is the landing
itself: API page files dropped into an inbox are appended to the landing
table exactly once (file-source offsets + checkpoint), so the batch report
can be rerun at any time over everything landed so far.
"""

from subledger.streaming.landing_ingest import ingest_pages

__all__ = ["ingest_pages"]
