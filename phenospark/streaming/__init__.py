"""Streaming.

The workflow is batch only: no stream, watermark, window or state exists in
it. The one stage that can run incrementally as-is is matching new records
to the codelist (a stream-static join); :mod:`phenospark.streaming.incremental`
runs that same operator on a stream.
"""
