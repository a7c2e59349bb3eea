"""Plans: the three questions, feed derivations, query registry, oracles."""
