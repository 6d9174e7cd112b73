"""Column functions: R-faithful text helpers and the status rule sets."""
