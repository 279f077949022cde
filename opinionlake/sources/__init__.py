"""Reading bronze, silver and gold; writing tables and snapshots."""
