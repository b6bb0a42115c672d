"""Every operator as a query over the driver's tables, with its reference SQL."""
