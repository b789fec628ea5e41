"""Sources and sinks: file trees, JSON exchange files, stores and state."""
