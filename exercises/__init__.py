"""The operators applied to the test tables, each with its SQL counterpart."""
