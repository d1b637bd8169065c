"""Every operator as a query over the given tables, each with its SQL counterpart."""
