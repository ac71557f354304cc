"""Reusable DataFrame operators: ordered scans, overlap joins, ranks, policy lookup, keyed inserts."""
