"""riskpanel: weekly risk panels over incident tables, as Spark DataFrame jobs."""
