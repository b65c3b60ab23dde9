"""Named queries, their SQL twins, and the read API."""
