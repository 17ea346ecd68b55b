"""Reusable DataFrame operators: history, spans, unnesting, lookups, output contracts."""
