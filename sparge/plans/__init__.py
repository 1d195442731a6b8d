"""Jobs that connect sources, operators and sinks, and the dashboard panels."""
