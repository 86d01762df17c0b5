"""Training-data operators: classifiers, duplicates, packing, fingerprints, archives, rules and tokens over documents."""
