"""Plans: step composition (``pipeline``), registered queries (``queries``)
and their independent SQL oracles (``oracle``)."""
