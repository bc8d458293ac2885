"""Sources and sinks: document files and tables in, chunk table out, import reports."""
