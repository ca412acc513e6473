"""Column-level building blocks: time buckets, geometry and geodesic measures."""
