"""DataFrame-to-DataFrame operators, and fits that learn small parameter sets."""
