"""Sources and sinks: the only modules that touch paths."""
