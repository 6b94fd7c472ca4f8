"""Table writes: snapshots with upsert, materialisation, export and serving refresh."""
