"""Column functions over text: patterns, tokens, numbers, scripts, plural rules."""
