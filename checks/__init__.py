"""Every operator as a query over the given tables, and the SQL it must equal."""
