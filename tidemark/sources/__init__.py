"""Sources and sinks: CSV, event topics."""
