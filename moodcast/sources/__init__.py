"""Scans and sinks (``files``) and views over the provided tables (``testdata``)."""
