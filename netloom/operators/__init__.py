"""DataFrame to DataFrame operators of the flow engine."""
