"""Table-level operators (``DataFrame -> DataFrame``) of every layer."""
