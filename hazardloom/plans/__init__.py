"""Analysis stages, the loan views over the supplied tables and the query catalog."""
