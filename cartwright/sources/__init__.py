"""Reading and writing tables: snapshots, typed loads, publishing, CSV export."""
