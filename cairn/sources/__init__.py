"""Sources and sinks: tables, stand-in views, versioned registry, models, SQL, generation."""
