"""Reading and writing: CSV drops, raw pages, snapshots and warehouse tables."""
