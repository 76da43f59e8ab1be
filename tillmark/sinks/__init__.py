"""Where results go: Parquet marts, snapshots, appended tables, quarantine."""
