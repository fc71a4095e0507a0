"""Column expressions: dates, statuses, texts, paths, keys, responses and table cells."""
