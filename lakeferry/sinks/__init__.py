"""Writers: raw and clean tables, day reloads, published snapshots, exports, reports, messages."""
