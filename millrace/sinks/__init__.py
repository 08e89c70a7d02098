"""Target tables: history, latest load, snapshots, upserts and logs."""
