"""Sources and sinks: topics, tables, JDBC, and the sample-table mapping."""
