"""Sources and sinks: derived test staging, CSV extracts, file listings."""
