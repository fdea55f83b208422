"""The retail configuration of the operators: feeds, specifications, star schema, reports, gate."""
