"""Column functions: text, verdicts, style features, transcripts, prompts."""
