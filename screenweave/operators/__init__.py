"""Operators on frames: keyed selection, statistics, spatial and track joins, barcodes, image tiles."""
