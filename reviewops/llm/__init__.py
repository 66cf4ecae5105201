"""Training-data operators: deduplication, decontamination, language, secrets,
personal data, tokens and URLs.  Nothing outside this package imports it."""
