"""Stand-in tables built from the driver data set, and the registered queries."""
