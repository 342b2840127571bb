"""End-to-end fit / transform and the registered queries."""
