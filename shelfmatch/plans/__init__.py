"""Query plans over the driver tables: catalogue derivations and the query catalogue."""
