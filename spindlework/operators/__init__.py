"""DataFrame operators: records, joins, KPIs, star schema, profiles, models, metrics."""
