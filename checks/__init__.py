"""The registered queries: study-shaped inputs from the driver's tables, Spark jobs, SQL to compare."""
