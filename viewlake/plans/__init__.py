"""Jobs made of operators, sources and sinks."""
