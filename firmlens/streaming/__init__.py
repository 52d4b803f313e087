"""Incremental loads: high-water-mark batches and the landing-folder stream."""
