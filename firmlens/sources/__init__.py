"""Sources and sinks: files (CSV, labels), JSON pages and GeoJSON, JDBC, table sinks."""
