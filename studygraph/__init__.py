"""studygraph: DataFrame operators for structured study documents."""
