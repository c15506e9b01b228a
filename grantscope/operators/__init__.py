"""Operators: joins, detection rules, findings, summaries, views, evidence."""
