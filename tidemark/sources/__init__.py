"""Sources and sinks: stream readers, JDBC, and the CDC table store."""
