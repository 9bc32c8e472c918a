"""Sinks: reject lines, the processed table, report files, JDBC."""
