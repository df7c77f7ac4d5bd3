"""Writers, upserts and rolling refresh on plain Parquet."""
