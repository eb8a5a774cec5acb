"""Query plans over the driver tables: role mapping, registered queries and
their SQL oracles."""
