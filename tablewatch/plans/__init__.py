"""Composite plans: staging, warehouse, the check suite, report views, derived metadata
and the registered queries (``registered.QUERIES`` / ``registered.ORACLE``)."""
