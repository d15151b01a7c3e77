"""DataFrame operators: normalise, tag, split, check, judge and join."""
