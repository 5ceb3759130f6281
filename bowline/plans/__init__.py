"""Query plans over the driver tables: the ``queries()`` / ``oracle_sql()`` registry."""
