"""Input views over the driver tables, registered queries and their DuckDB counterparts."""
