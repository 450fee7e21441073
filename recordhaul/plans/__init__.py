"""End-to-end jobs put together from sources, operators and sinks."""
