"""Raw-shaped proxies, file sources and sinks."""
