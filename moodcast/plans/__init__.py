"""Composed analyses: shared base frames (``workspace``) and the query
catalog with its SQL oracle (``catalog``)."""
