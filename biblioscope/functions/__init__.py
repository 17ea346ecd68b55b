"""Column helpers: text, JSON documents, dates and casts. All are built-in expressions."""
