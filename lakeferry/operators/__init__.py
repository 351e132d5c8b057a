"""DataFrame operators: latest version per key, merges, diffs, guards, features, reports."""
