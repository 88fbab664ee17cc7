"""Typed readers for landing feeds and the test-fixture adapter."""
