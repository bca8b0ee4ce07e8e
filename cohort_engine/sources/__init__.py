"""Reading tables, fixture cohorts, schema validation and result sinks."""
