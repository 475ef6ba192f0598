"""Row-level and table-level operators of the warehouse."""
