"""Column functions: texts, responses, chat turns, tokens and metrics."""
