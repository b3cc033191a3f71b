"""DataFrame operators: duplicates, joins, ordered scans, profiles, graphs."""
