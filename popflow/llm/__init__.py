"""Operators for a training-data pipeline; nothing else in popflow imports them."""
