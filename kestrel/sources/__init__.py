"""Sources and sinks: table loading, text / CSV / JSON scans, raw-text
parsers, local rows, CSV and text sinks, views, caching and schema reports."""
