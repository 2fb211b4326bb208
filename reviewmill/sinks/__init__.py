"""Writers of summaries, nested documents, vocabularies and vectors."""
