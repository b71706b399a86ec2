"""Market-data ELT, quality gates and research jobs as Spark DataFrame functions."""
