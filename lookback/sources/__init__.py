"""Sources and sinks: yearly files, codebook, code-list text, JDBC options, demo views, writers."""
