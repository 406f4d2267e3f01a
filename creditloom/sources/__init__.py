"""Tables in and out: the book, fitted artefacts, staging, views over base tables."""
