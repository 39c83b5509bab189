"""Sources and sinks: files, catalog tables, views."""
