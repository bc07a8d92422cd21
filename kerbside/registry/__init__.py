"""The registered queries: every operator over trips that Spark derives from the given tables, with its SQL twin."""
