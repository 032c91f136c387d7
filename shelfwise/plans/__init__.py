"""Plans: snapshot build, star schema, analytics, quality, control, query registry."""
