"""DataFrame operators: product lists, propensity, behaviour, text, vectors."""
