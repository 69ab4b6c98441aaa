"""Jobs: product builds, layer runs, backfill and daily loads."""
