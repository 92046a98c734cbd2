"""Query plans: the registered queries, their SQL oracles and the Atom
round-trip fixture built from the driver tables."""
