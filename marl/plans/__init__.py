"""Query plans over the driver tables, and the planning helpers they share."""
