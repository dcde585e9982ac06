"""Complete audits, put together from the operators."""
