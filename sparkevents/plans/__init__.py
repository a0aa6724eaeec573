"""Test carriers, end-to-end plans and the query catalogue."""
