"""DataFrame operators: duplicates, quality rules, windows, chunks, upserts, contracts."""
