"""Sources and sinks: message catalogues and other text files."""
