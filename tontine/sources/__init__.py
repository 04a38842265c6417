"""Input tables, text/JDBC connectors and month-partitioned sinks."""
