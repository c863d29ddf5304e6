"""Pipeline jobs (P1-P6) and the query catalogue over the driver tables."""
