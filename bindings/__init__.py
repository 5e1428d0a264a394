"""The operators bound to the star-schema tables, and the same questions in plain SQL."""
